from ringwatch.sources.patterns import parse_patterns, parse_patterns_with_rejects, rings_from_transfers, write_patterns_text

TEXT = """BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 2-degree Fan-Out
2021/03/14 09:26,000535,ZQ81,007,KX22,314.15,Yen,314.15,Yen,Cheque,1
2021/03/14 15:09,000535,ZQ81,042,KX97,271.82,Yen,271.82,Yen,Cheque,1
END LAUNDERING ATTEMPT - FAN-OUT

BEGIN LAUNDERING ATTEMPT - CYCLE
2021/05/06 07:08,9,0009,8,0008,5.50,Euro,5.50,Euro,Cash,1
2021/05/06 08:09,8,0008,9,0009,4.25,Euro,4.25,Euro,Cash,1
END LAUNDERING ATTEMPT - CYCLE
"""


def test_two_blocks(spark, tmp_path):
    p = tmp_path / "rings.txt"
    p.write_text(TEXT)
    rows = parse_patterns(spark, str(p)).orderBy("pattern_id", "hop").collect()
    assert len(rows) == 4
    assert [(r.pattern_id, r.hop) for r in rows] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert rows[0].pattern_type == "FAN-OUT" and rows[0].pattern_detail == "Max 2-degree Fan-Out"
    assert rows[2].pattern_type == "CYCLE" and rows[2].pattern_detail == ""
    assert rows[0].from_bank == "000535" and rows[2].from_account == "0009"  # ids stay strings
    assert rows[0].amount_paid == 314.15 and rows[0].is_laundering == 1


def test_stray_and_malformed_rows_are_rejected(spark, tmp_path):
    text = ("2021/01/01 00:00,1,A,2,B,1.0,Euro,1.0,Euro,Cash,1\n" + TEXT +
            "BEGIN LAUNDERING ATTEMPT - lower case\n2021/01/03 00:00,1,A,2,B,1.0,Euro,1.0,Euro,Cash,1\n"
            "END LAUNDERING ATTEMPT - x\nshort,line\n")
    p = tmp_path / "rings.txt"
    p.write_text(text)
    rings, rejects = parse_patterns_with_rejects(spark, str(p))
    assert rings.count() == 4
    assert rejects.count() == 2


def test_round_trip_many_files(spark, tmp_path):
    import datetime as dt
    from ringwatch.sources.transfers import TRANSFER_SCHEMA
    rows = []
    for i in range(60):
        for h in range(1 + i % 3):
            rows.append((i * 10 + h, dt.datetime(2022, 9, 1, h, i % 60), "001", f"A{i}", "002", f"B{h}", 1.5, "Euro",
                         1.5, "Euro", "ACH", 1))
    df = spark.createDataFrame(rows, TRANSFER_SCHEMA)
    from pyspark.sql import functions as F
    rings = rings_from_transfers(df.withColumn("pattern_id", (F.col("txn_id") / 10).cast("int")))
    path = str(tmp_path / "out")
    write_patterns_text(rings, path)
    back = parse_patterns(spark, path)
    a = sorted((r.pattern_id, r.hop, r.from_account) for r in rings.collect())
    b = sorted((r.pattern_id, r.hop, r.from_account) for r in back.collect())
    assert a == b
