from datetime import date, datetime

from tallyspark import schemas
from tallyspark.__main__ import main
from tallyspark.functions.derive import add_row_features
from tallyspark.operators import clean, filters, users
from tallyspark.operators.star import build_star
from tallyspark.sources import readers, writers
from tallyspark.streaming import intake
from tests.data import profiles, transactions


def _table(spark):
    return transactions(
        spark, {"merchant": 'A "quoted", name'}, {"failure_reason": "x", "status": "Failed"},
        {"transaction_datetime": datetime(2024, 2, 3, 4, 5, 6)})


def test_csv_round_trip(spark, tmp_path):
    t, u = _table(spark), profiles(spark, {}, {"user_id": "USR2"})
    writers.write_csv(t, f"{tmp_path}/t")
    writers.write_csv(u, f"{tmp_path}/u")
    t2, u2 = readers.read_raw_pair(spark, f"{tmp_path}/t", f"{tmp_path}/u")
    assert sorted(map(str, t2.collect())) == sorted(map(str, t.collect()))
    assert sorted(map(str, u2.collect())) == sorted(map(str, u.collect()))


def test_bad_rows_are_kept_apart_or_coerced(spark, tmp_path):
    lines = [",".join(schemas.TRANSACTIONS.fieldNames()),
             "T1,U1,2024-01-01 00:00:00,UPI,Travel,M,abc,Success,,Mobile App,iOS,Pune,1.0,0,0,0,"
             "True,,False,0"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    corrupt = readers.read_transactions(spark, str(tmp_path / "t.csv"), keep_corrupt=True).cache()
    assert corrupt.filter("_corrupt_record IS NOT NULL").count() == 1
    row = readers.read_transactions_lenient(spark, str(tmp_path / "t.csv")).first()
    assert row.amount is None and row.is_flagged is True and row.user_id == "U1"


def test_enriched_round_trips(spark, tmp_path):
    e = users.enrich(_table(spark), profiles(spark, {}))
    writers.write_enriched(e, f"{tmp_path}/p")
    back = readers.read_enriched(spark, f"{tmp_path}/p").select(*schemas.ENRICHED_COLUMNS)
    assert sorted(map(str, back.collect())) == sorted(map(str, e.collect()))
    writers.write_enriched(e, f"{tmp_path}/c", "csv")
    csv = readers.read_enriched_csv(spark, f"{tmp_path}/c").select(*schemas.ENRICHED_COLUMNS)
    assert sorted(map(str, csv.collect())) == sorted(map(str, e.collect()))


def test_star_round_trips(spark, tmp_path):
    star = build_star(add_row_features(_table(spark)), profiles(spark, {}))
    for form in ("csv", "parquet"):
        writers.write_star(star, f"{tmp_path}/{form}", form)
        back = readers.load_star(spark, f"{tmp_path}/{form}", form)
        assert {n: t.count() for n, t in back.items()} == {
            "fact_transactions": 3, "dim_date": 2, "dim_users": 1, "dim_payment_method": 5,
            "dim_category": 10, "dim_platform": 4}
        assert back["fact_transactions"].columns == schemas.FACT_COLUMNS


def test_shared_folder_follows_the_session(spark):
    class Conf:
        def get(self, key, default):
            return {"spark.checkpoint.dir": "hdfs:///shared/cp/"}.get(key, default)

    class Session:
        conf = Conf()

    first, second = (writers.shared_folder(Session(), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/cp/tallyspark-x-") and first != second
    assert writers.shared_folder(spark, "x").startswith("/")


def test_intake_gives_the_batch_result(spark, tmp_path):
    t, u = _table(spark), profiles(spark, {})
    writers.write_csv(t, f"{tmp_path}/in")
    stream = intake.feature_stream(intake.read_transaction_stream(spark, f"{tmp_path}/in"), u)
    intake.start_intake(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out")
    want = intake.feature_stream(clean.strip_text(t), u)
    names = [c for c in want.columns if c in got.columns]
    assert sorted(map(str, got.select(names).collect())) == sorted(
        map(str, want.select(names).collect()))
    # A second run finds nothing new.
    intake.start_intake(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_command_line(spark, tmp_path):
    writers.write_csv(_table(spark), f"{tmp_path}/t")
    writers.write_csv(profiles(spark, {}), f"{tmp_path}/u")
    inputs = ["--transactions", f"{tmp_path}/t", "--profiles", f"{tmp_path}/u"]
    main(["enrich", *inputs, "--out", f"{tmp_path}/e"], spark)
    assert readers.read_enriched(spark, f"{tmp_path}/e").count() == 3
    main(["star", *inputs, "--out", f"{tmp_path}/s"], spark)
    assert readers.load_star(spark, f"{tmp_path}/s", "parquet")["dim_users"].count() == 1
    main(["report", "sql_1a_overall_success", *inputs, "--out", f"{tmp_path}/r"], spark)
    assert spark.read.parquet(f"{tmp_path}/r").first().total_transactions == 3


def test_date_filters_skip_months(spark, tmp_path):
    t = transactions(spark, *[{"transaction_datetime": datetime(2024, m, 5, 12)} for m in (1, 2, 3)])
    writers.write_by_month(t, f"{tmp_path}/t")
    for ends in ({"date_from": date(2024, 2, 1), "date_to": date(2024, 2, 29)}, {"date_from": date(2024, 3, 1)},
                 {"date_to": date(2024, 1, 31)}, {"date_from": date(2024, 2, 29), "date_to": date(2024, 2, 1)}):
        january = filters.apply_filters(readers.read_enriched(spark, f"{tmp_path}/t"), **ends)
        assert january.count() == 1
        plan = january._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(txn_month" in plan
