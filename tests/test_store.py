"""Store, backfills, splits, modelling and monitoring end to end on the smallest tables."""

from datetime import date
from pathlib import Path

import pytest
from lendlake import schemas as S
from lendlake.functions.dates import month_list
from lendlake.operators import bronze, lookup, metrics, silver, splits
from lendlake.plans import backfill, modelling, monitoring, queries
from lendlake.plans.queries import assigned, model_table
from lendlake.sources import driver_tables, text
from lendlake.sources.scratch import scratch_root, written
from lendlake.sources.store import Store
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
GOLD = [("gold", name) for name in ("label_store", "engagement", "risk", "model_table")]


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def sources(spark):
    return {name: source(spark, SF_DIR) for name, source in driver_tables.SOURCES.items()}


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return backfill.backfill(spark, str(tmp_path_factory.mktemp("full")), sources(spark))


def test_backfill_equals_composed_operators(spark, store):
    assert rows(store.read("gold", "model_table")) == rows(model_table(spark, SF_DIR))


def test_backfill_from_text_files(spark, store, tmp_path):
    for name, df in sources(spark).items():
        text.write_source(df.select(*S.RAW_COLUMNS[name]), f"{tmp_path}/{name}")
    read = {name: text.read_source(spark, f"{tmp_path}/{name}") for name in S.RAW_COLUMNS}
    other = backfill.backfill(spark, f"{tmp_path}/store", read)
    for layer, table in [("silver", name) for name in S.RAW_COLUMNS] + GOLD:
        assert rows(other.read(layer, table)) == rows(store.read(layer, table)), table


def test_files_with_other_headers_are_united_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("Ann", "40", "2023-01-01")], "Name string, Age string, snapshot_date string")
    for df in (rows, rows.select("Age", "Name", "snapshot_date"), rows.drop("Age").withColumn("Town", F.lit("a, b"))):
        text.write_source(df, str(tmp_path), "append")
    found = text.read_source(spark, str(tmp_path))
    assert set(found.columns) == {"Name", "Age", "Town", "snapshot_date"}
    expected = [("Ann", "40", None)] * 2 + [("Ann", None, "a, b")]
    assert sorted(map(tuple, found.select("Name", "Age", "Town").collect()), key=repr) == sorted(expected, key=repr)
    assert text.rejected_lines(spark, str(tmp_path)).isEmpty()


LINES = [
    ("1,Ann,2023-01-01", None),
    ('2,"A, b",2023-02-01', None),
    ('3,5" pipe,2023-02-01', None),
    ('4,"a\\"b",2023-02-01', None),
    ('5,"say ""hi""",2023-02-01', None),
    ('15,"say ""hi"", twice",2023-02-01', text.UNREADABLE),  # quotes within a cell follow a backslash in these sources
    ("6,,", None),
    ("7,\u65e5\u672c \U0001f389," + "9" * 100_000, None),
    ("8,Bob", text.TOO_FEW),
    ("x" * 100_000, text.TOO_FEW),
    ("9,Bob,2023-03-01,", text.TOO_MANY),
    ('10,"Bob, junior",2023-03-01,"x"', text.TOO_MANY),
    ('11,"Bob,2023-03-01', text.UNCLOSED),
    ('12,Bob,"2023-03-01', text.UNCLOSED),
    ('13,Bob,"2023-03-01""', text.UNCLOSED),
    ('14,"Bob\\",2023-03-01', text.UNCLOSED),
]


def test_malformed_lines_are_kept_as_text_with_their_reason(spark, tmp_path):
    for part in range(3):
        ends = "\r\n" if part else "\n"
        lines = ["id,Name,snapshot_date", "", *[line for line, _ in LINES[part::3]], "  ", "id,Name,snapshot_date"]
        (tmp_path / f"part{part}.csv").write_text(ends.join(lines), "utf-8-sig" if part == 2 else "utf-8", newline="")
    found = text.rejected_lines(spark, str(tmp_path))
    assert sorted((r.line, r.reason) for r in found.collect()) == sorted((line, why) for line, why in LINES if why)
    read = {r.id: r.Name for r in text.read_source(spark, str(tmp_path)).collect()}
    assert read.keys() == {line.split(",")[0] for line, why in LINES if not why}
    assert (read["2"], read["4"], read["6"]) == ("A, b", 'a"b', None)


def test_a_line_is_parsed_once(spark, tmp_path):
    """Filters on cells and reasons do not repeat the parser, and no pattern runs on lines that cannot hold it."""
    rows = spark.createDataFrame([("Ann", "40", "2023-01-01")], "Name string, Age string, snapshot_date string")
    text.write_source(rows, str(tmp_path))
    dated = bronze.snapshot_slices(text.read_source(spark, str(tmp_path)))
    for df in (dated, text.rejected_lines(spark, str(tmp_path))):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert "file_path" not in dated._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in dated.collect()] == [("Ann", "40", date(2023, 1, 1))]


def test_plain_lines_are_cut_at_their_separators(spark, tmp_path):
    """Only lines with a quote or a mark of the CSV reader go through it; cells are the same either way."""
    lines = ["a,b,c", " 1, 2 ,3", ",,", "x,,z", "p,\\,q", '"u,v",w,x', "1,2", "1,2,3,4", "é,#,\t"]
    path = f"{tmp_path}/lines"
    text.write_lines(spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1), "h1,h2,h3", path)
    found = [tuple(r)[:3] for r in text.read_source(spark, path).collect()]
    expected = spark.createDataFrame([(line,) for line in lines if line not in ("1,2", "1,2,3,4")], "line string")
    cells = expected.select(F.from_csv("line", F.lit("h1 string, h2 string, h3 string")).alias("row")).select("row.*")
    assert sorted(found, key=str) == sorted([tuple(r) for r in cells.collect()], key=str)
    assert (" 1", " 2 ", "3") in found and ("u,v", "w", "x") in found and (None, None, None) in found
    rejected = {r.line: r.reason for r in text.rejected_lines(spark, path).collect()}
    assert rejected == {"1,2": text.TOO_FEW, "1,2,3,4": text.TOO_MANY}
    plain = spark.createDataFrame([(line,) for line in [*lines, "\0a,b,c"]], "line string").where(text.is_plain(F.col("line")))
    assert plain.count() == 7
    plan = text.read_source(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") >= 1 and plan.count("from_csv(") == 1


def test_run_counts_reads_its_text_once(spark, monkeypatch):
    """The repeated financial rows do not come from a second pass over the text."""
    given = {}
    monkeypatch.setattr(queries.backfill, "backfill", lambda spark, root, sources: given.update(sources) or Store(spark, root))
    monkeypatch.setattr(Store, "read", lambda self, *_: None)
    queries.run_counts(spark, SF_DIR)
    financials = given["financials"]
    assert financials._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    fives = F.col("Customer_ID").endswith("5")
    once = driver_tables.raw_financials(spark, SF_DIR)
    assert financials.count() == once.count() + once.where(fives).count()
    assert "copy" not in financials.columns


def test_marks_of_other_systems_are_no_part_of_a_line(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffid,Name\r\n1,Ann\r\n\r\n2,\ufeffBob\r\n".encode())
    assert sorted((r.id, r.Name) for r in text.read_source(spark, str(tmp_path)).collect()) == [("1", "Ann"), ("2", "\ufeffBob")]


def test_no_lines_at_all(spark, tmp_path):
    spark.createDataFrame([], "line string").write.mode("append").text(str(tmp_path))
    assert text.read_source(spark, str(tmp_path)).isEmpty() and text.rejected_lines(spark, str(tmp_path)).isEmpty()


def test_rejected_lines_of_a_source_are_replaced(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    line = spark.createDataFrame([("f", text.TOO_FEW, "1,2")], "file string, reason string, line string")
    backfill.build_rejects(store, {"loans": line, "financials": line.union(line)})
    backfill.build_rejects(store, {"loans": line.limit(0)})
    assert [r.source_table for r in store.read("bronze", "rejected_lines").collect()] == ["financials"] * 2


def test_a_write_leaves_out_whole_folders_only(spark, tmp_path):
    """Folders without rows in a later write go, those of other months stay, and no file of a replaced folder is left."""
    store = Store(spark, str(tmp_path))
    days = spark.createDataFrame([(f"L{i}", date(2023, 1 + i % 4, 1)) for i in range(40)], "loan_id string, snapshot_date date")
    full = days.select(*[F.col(c) if c in days.columns else F.lit(None).alias(c) for c in S.RAW_COLUMNS["loans"]])
    store.write(full, "bronze", "loans")
    assert store.counts["bronze", "loans"] == {"rows_out": 40}
    store.write(full.where("snapshot_date = '2023-02-01'"), "bronze", "loans", [date(2023, 1, 1), date(2023, 2, 1)])
    assert store.months("bronze", "loans") == [date(2023, 2, 1), date(2023, 3, 1), date(2023, 4, 1)]
    assert store.read("bronze", "loans").count() == 30
    store.write(full.where("snapshot_date = '2023-03-01'"), "bronze", "loans")
    assert store.months("bronze", "loans") == [date(2023, 3, 1)] and store.read("bronze", "loans").count() == 10


def test_counts_of_a_month_run(spark, tmp_path):
    """A run counts its own months and the undated rows; the tables it did not write keep their counts."""
    days = [("a", date(2023, 1, 1)), ("b", date(2023, 2, 1)), ("c", None), ("d", date(2023, 2, 1))]
    raw = spark.createDataFrame(days, "loan_id string, snapshot_date date")
    full = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).alias(c) for c in S.RAW_COLUMNS["loans"]])
    store = Store(spark, str(tmp_path))
    counts = {}
    for months in (None, [date(2023, 2, 1)], [date(2023, 5, 1)]):
        backfill.build_bronze(store, {"loans": full}, months)
        counts[str(months)] = store.counts["bronze", "loans"]
        store.write_counts()
    assert list(counts.values()) == [{"rows_out": n, "rows_in": n + 1, "undated": 1} for n in (3, 2, 0)]
    store.counts["gold", "risk"] = {"rows_out": 3, "repeated_rows": 1}
    store.write_counts()
    kept = store.read("meta", "run_counts").orderBy("layer").select("table_name", "rows_in", "undated", "repeated_rows", "rows_out").collect()
    assert [tuple(r) for r in kept] == [("loans", 1, 1, None, 0), ("risk", None, None, 1, 3)]


def test_repeated_feature_rows_are_counted_by_snapshot(spark):
    rows = [("a", date(2023, 1, 1))] * 3 + [("b", date(2023, 1, 1)), ("a", date(2023, 2, 1)), (None, date(2023, 2, 1)), (None, date(2023, 2, 1))]
    found = lookup.repeated_rows(spark.createDataFrame(rows, "Customer_ID string, snapshot_date date"), S.KEY)
    assert {r.snapshot_date: r.repeated_rows for r in found.collect()} == {date(2023, 1, 1): 2, date(2023, 2, 1): 1}


def test_bronze_shuffles_numbers_and_not_their_text(spark, tmp_path, monkeypatch):
    """Rows are cast above the shuffle; a ledger stored by snapshot is not shuffled again."""
    plans, write = [], Store.write

    def seen(self, df, *args, **more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(self, df, *args, **more)

    monkeypatch.setattr(Store, "write", seen)
    loans = driver_tables.raw_loans(spark, SF_DIR)
    ledger = written(loans, "ledger", by=S.SNAPSHOT)
    found = []
    for source, aligned in ((loans, False), (ledger, True)):
        store = Store(spark, f"{tmp_path}/{aligned}")
        backfill.build_bronze(store, {"loans": source}, aligned=aligned)
        found.append(rows(store.read("bronze", "loans")))
    assert found[0] == found[1] and len(found[0]) == loans.count()
    assert plans[0].index("cast(loan_amt") < plans[0].index("RebalancePartitions")
    assert "RebalancePartitions" not in plans[1] and "Join" not in plans[1]


def test_undated_rows_are_counted(spark):
    dates = spark.createDataFrame([("2023-01-01",), ("01/02/2023",), (None,)], "day string")
    dates = dates.select(F.col("day").try_cast("date").alias("snapshot_date"))
    assert [tuple(r) for r in bronze.rejected_counts({"loans": dates, "none": dates.limit(0)}).collect()] == [("loans", 2)]
    assert bronze.snapshot_slices(dates).count() == 1


def test_other_columns_pass_through(spark, tmp_path):
    raw = sources(spark)["attributes"].withColumn("Region", F.lit("north"))
    shuffled = raw.select("Region", *reversed(S.RAW_COLUMNS["attributes"]))
    text.write_source(shuffled, f"{tmp_path}/attributes")
    read = {"attributes": text.read_source(spark, f"{tmp_path}/attributes")}
    part = Store(spark, f"{tmp_path}/store", backfill.other_columns(read))
    backfill.build_bronze(part, read)
    assert part.read("bronze", "attributes").where("Region = 'north'").count() == raw.count()
    out = silver.silver_attributes(part.read("bronze", "attributes"))
    part.write(out, "silver", "attributes", aligned=True)
    assert rows(part.read("silver", "attributes").drop("Region")) == rows(silver.silver_attributes(raw).drop("Region"))
    assert part.read("silver", "attributes").where("Region = 'north'").count() == raw.count()


def test_months_one_by_one_equal_the_full_run(spark, store, tmp_path):
    months = month_list("1998-01-01", "1998-03-01")
    for month in [months[2], months[0], months[1], months[1]]:
        needed = month_list(date(1997, 7, 1), date(1998, 3, 1))
        part = Store(spark, str(tmp_path))
        if not Path(part.path("silver", "clickstream")).exists():
            backfill.build_bronze(part, sources(spark), needed)
            backfill.build_silver(part, needed)
        backfill.backfill(spark, str(tmp_path), sources(spark), [month])
    for layer, table in GOLD:
        full = bronze.snapshot_slices(store.read(layer, table), months)
        assert rows(Store(spark, str(tmp_path)).read(layer, table)) == rows(full), table


def test_a_second_write_replaces_only_its_months(spark, tmp_path):
    part = Store(spark, str(tmp_path))
    ddl = S.TABLES["gold", "label_store"]
    first = [(f"L{m}{i}", "C", 0, "d", date(2023, m, 1)) for m in (1, 2, 3) for i in range(3)]
    part.write(spark.createDataFrame(first, ddl), "gold", "label_store")
    again = spark.createDataFrame([("new", "C", 1, "d", date(2023, 2, 1))], ddl)
    months = [date(2023, 2, 1), date(2023, 3, 1)]
    for _ in range(2):
        part.write(again, "gold", "label_store", months)
    counts = part.row_counts(("gold", "label_store")).orderBy("snapshot_date").collect()
    assert [(r.snapshot_date.month, r.row_count) for r in counts] == [(1, 3), (2, 1)]
    assert part.read("gold", "label_store", [date(2030, 1, 1)]).count() == 0


def test_a_large_month_is_written_by_many_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        df = spark.range(200_000).selectExpr(
            "cast(uuid() as string) as loan_id", "'C' as Customer_ID", "1 as label", "'d' as label_def",
            "if(id % 3 = 0, date'2023-01-01', add_months(date'2023-02-01', cast(id % 7 as int))) as snapshot_date",
        )
        Store(spark, str(tmp_path)).write(df, "gold", "label_store")
    finally:
        spark.conf.unset(size)
    files = list(Path(tmp_path).glob("gold/label_store/snapshot_date=2023-01-01/*.parquet"))
    assert len(files) > 4


def test_reading_one_month_prunes_partitions(store):
    plan = store.read("silver", "loans", [date(1998, 6, 1)])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_splits_are_a_partition_and_do_not_depend_on_layout(spark, store):
    table = store.read("gold", "model_table")
    out = splits.assign_splits(table)
    assert out.count() == table.count()
    assert rows(out) == rows(splits.assign_splits(table.repartition(13)))
    by_month = out.groupBy("snapshot_date").agg(F.collect_set("split").alias("sets")).orderBy("snapshot_date").collect()
    assert set().union(*[r.sets for r in by_month[:12]]) == {"train", "test", "val"}
    assert [r.sets for r in by_month[12:15]] == [["oot1"], ["oot2"], ["oot3"]]
    assert {s for r in by_month[15:] for s in r.sets} == {"monitor"}


def test_splits_shares(spark):
    df = splits.hash_split(spark.range(20_000), "id")
    shares = {r.split: r["count"] / 20_000 for r in df.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.7, "test": 0.2, "val": 0.1}, abs=0.02)


def test_other_shares(spark):
    df = splits.hash_split(spark.range(20_000), "id", {"a": 1, "b": 1})
    shares = {r.split: r["count"] / 20_000 for r in df.groupBy("split").count().collect()}
    assert shares == pytest.approx({"a": 0.5, "b": 0.5}, abs=0.02)
    assert splits.hash_split(spark.range(5), "id", {"all": 1}).where("split = 'all'").count() == 5


def test_splits_wait_for_enough_months(store):
    early = store.read("gold", "model_table").where("snapshot_date < '1995-08-01'")
    months = bronze.available_snapshots(early).count()
    assert splits.assign_splits(early, n_train=months + 1).count() == 0
    assert splits.assign_splits(early, n_train=months).count() == early.count()


def test_splits_month_by_month_equal_the_full_run(spark, store, tmp_path):
    part = Store(spark, str(tmp_path))
    table = store.read("gold", "model_table")
    months = sorted(r.snapshot_date for r in bronze.available_snapshots(table).collect())[:17]
    for month in months:
        part.write(bronze.snapshot_slices(table, [month]), "gold", "model_table", [month])
        backfill.build_splits(part, [month])
    full = splits.assign_splits(part.read("gold", "model_table"))
    assert rows(part.read("gold", "splits")) == rows(full)


@pytest.fixture(scope="module")
def scored(spark, store):
    backfill.build_splits(store)
    model_dir = modelling.train(store, "2024-12-01")
    for _ in range(2):
        manifest = modelling.score_sets(store, model_dir, "2024-12-01")
    return store, model_dir, manifest


def test_manifest_holds_one_row_per_set(scored):
    store, model_dir, manifest = scored
    lines = {r.split: r for r in manifest.collect()}
    assert manifest.count() == len(lines) == 2
    assert lines["test"].model_dir == model_dir
    predictions = store.read("gold", "predictions")
    areas = {r.split: r.auc for r in modelling.evaluate(predictions).collect()}
    assert {name: line.auc for name, line in lines.items()} == pytest.approx(areas)
    side = modelling.training_manifest(manifest).first()
    assert (side.auc_test, side.auc_val) == (lines["test"].auc, lines["val"].auc)


def test_predictions(scored):
    store, model_dir, _ = scored
    predictions = store.read("gold", "predictions")
    holdout = store.read("gold", "splits").where(F.col("split").isin("test", "val"))
    assert predictions.count() == holdout.count() > 0
    assert predictions.where("not probability between 0 and 1 or prediction != if(probability > 0.5, 1, 0)").count() == 0
    again = modelling.score(PipelineModel.load(model_dir), holdout)
    assert rows(again) == rows(predictions.drop("model_name", "run_date"))


def test_monitoring(scored):
    store, _, _ = scored
    test_rows = store.read("gold", "predictions").where("split = 'test'")
    last = test_rows.agg(F.max("snapshot_date")).first()[0]
    for _ in range(2):
        out = monitoring.monitor(store, "1995-01-01", last)
    expected = metrics.auc(test_rows, "label", "probability", ["snapshot_date"], "test_auc")
    assert rows(out) == rows(expected)
    assert monitoring.monitor_trailing(store, last, days=31).count() <= 2
    assert monitoring.monitor_trailing(store, "1980-01-01").count() == 0


def test_logistic_regression_equals_newton_steps(spark):
    np = pytest.importorskip("numpy")
    df = written(assigned(spark, SF_DIR).where("split = 'train'"), "newton")
    features = ["Interest_Rate", "Outstanding_Debt", "Loan_Extent"]
    model = modelling.fit_model(df, features)
    data = np.array([[r.label, *[r[c] if r[c] is not None else np.nan for c in features]] for r in df.collect()], float)
    y, x = data[:, 0], data[:, 1:]
    imputed = [model.stages[0].surrogateDF.first()[c] for c in features]
    x = np.where(np.isnan(x), imputed, x)
    x = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0, ddof=1)])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p))
    fitted = [model.stages[-1].intercept, *model.stages[-1].coefficients]
    assert fitted == pytest.approx(list(w), abs=1e-3)


def test_a_feature_without_values_is_left_out(spark):
    df = spark.range(100).selectExpr("'L' as loan_id", "date'2023-01-01' as snapshot_date", "cast(id % 2 as int) as label",
                                     "cast(id as double) as a", "cast(null as int) as b")
    model = modelling.fit_model(df, ["a", "b"])
    assert model.stages[0].getInputCols() == ["a"]
    assert modelling.score(model, df).count() == 100


def test_scratch_tables_use_the_named_folder(spark):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_full_rebuild_keeps_no_other_months(spark, tmp_path):
    part = Store(spark, str(tmp_path))
    ddl = S.TABLES["gold", "label_store"]
    for months in (range(1, 6), range(2, 4)):
        table = [(f"L{m}", "C", 0, "d", date(2023, m, 1)) for m in months]
        part.write(spark.createDataFrame(table, ddl), "gold", "label_store")
    assert part.months("gold", "label_store") == [date(2023, 2, 1), date(2023, 3, 1)]
    assert part.read("gold", "label_store").count() == 2


def test_no_row_is_in_two_sets_after_other_rebuilds(spark, store, tmp_path):
    part = Store(spark, str(tmp_path))
    table = store.read("gold", "model_table")
    months = bronze.available_snapshots(table).orderBy("snapshot_date").limit(18).collect()
    months = [r.snapshot_date for r in months]
    part.write(bronze.snapshot_slices(table, months[1:]), "gold", "model_table")
    for n_train in (12, 6):
        backfill.build_splits(part, n_train=n_train)
        assert rows(part.read("gold", "splits")) == rows(splits.assign_splits(part.read("gold", "model_table"), n_train))
    part.write(bronze.snapshot_slices(table, months[:1]), "gold", "model_table", months[:1])
    backfill.build_splits(part, months[:1], n_train=6)
    assert rows(part.read("gold", "splits")) == rows(splits.assign_splits(part.read("gold", "model_table"), 6))


def test_months_in_any_order_without_preloaded_silver(spark, store, tmp_path):
    months = month_list("1998-01-01", "1998-03-01")
    for month in reversed(months):
        part = backfill.backfill(spark, str(tmp_path), sources(spark), [month])
    whole = backfill.backfill(spark, str(tmp_path / "whole"), {n: bronze.snapshot_slices(d, months) for n, d in sources(spark).items()})
    for layer, table in GOLD:
        assert rows(part.read(layer, table)) == rows(whole.read(layer, table)), table


def test_runs_and_sets_keep_their_own_results(scored):
    store, model_dir, _ = scored
    last = store.read("gold", "predictions").agg(F.max("snapshot_date")).first()[0]
    before = rows(store.read("gold", "predictions"))
    first = rows(monitoring.monitor(store, "1995-01-01", last, "test"))
    lines = modelling.score_sets(store, model_dir, "2025-01-01", "other")
    monitoring.monitor(store, "1995-01-01", last, "val", "other")
    kept = store.read("gold", "predictions").where("model_name = 'logistic'")
    assert rows(kept) == before
    assert rows(monitoring.auc_over_time(store, "1995-01-01", last, "test")) == first
    paths = {r.preds_path for r in lines.collect()}
    assert len(paths) == 4 and all(Path(p).is_dir() for p in paths)


def test_areas_come_from_stored_counts_without_the_predictions(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rows = [(f"L{i}", date(2023, 1 + i % 4, 1), i % 3 % 2, (i * 7 % 11) / 10, 0.0, ("test", "val")[i % 5 // 4]) for i in range(200)]
    schema = "loan_id string, snapshot_date date, label int, probability double, prediction double, split string"
    scored = spark.createDataFrame(rows, schema)
    manifest = {r.split: r.auc for r in modelling.record(store, scored, "m", "2024-01-01").collect()}
    assert manifest == {r.split: r.auc for r in modelling.evaluate(scored).collect()}
    read = store.read
    monkeypatch.setattr(store, "read", lambda layer, table, months=None: (_ for _ in ()).throw(AssertionError) if table == "predictions" else read(layer, table, months))
    series = monitoring.monitor(store, "2023-02-01", "2023-03-31").collect()
    kept = scored.where("split = 'test' and snapshot_date between '2023-02-01' and '2023-03-31'")
    assert [tuple(r) for r in series] == [tuple(r) for r in metrics.auc_by_snapshot(kept, "2023-02-01", "2023-03-31").collect()]
    found = {r.split: r.auc for r in monitoring.auc_of_range(store, "2023-02-01", "2023-03-31", ["test"]).collect()}
    assert found == {"test": metrics.auc(kept, "label", "probability").first().auc}
    monkeypatch.undo()
    modelling.record(store, scored.where("snapshot_date > '2023-01-01'"), "m", "2024-01-01", sets=["test"])
    again = store.read("gold", "score_counts").groupBy("split").agg(F.sum("bads") + F.sum("goods"), F.min("snapshot_date")).collect()
    assert {r[0]: r[2] for r in again} == {"test": date(2023, 2, 1), "val": date(2023, 1, 1)}


def test_a_fitted_model_scores_after_observed_writes(spark, store):
    rows = written(assigned(spark, SF_DIR), "splits")
    Store(spark, scratch_root(spark)).write(rows, "gold", "splits")
    model = modelling.fit_model(rows.where("split = 'train'"))
    assert modelling.evaluate(modelling.score(model, rows.where("split in ('test', 'val')"))).count() == 2
