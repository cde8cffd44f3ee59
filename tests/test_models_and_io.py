"""Splits, model fits, scoring, sources, redaction, streams and the entry module."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import customer, customers
from riskspark.functions.redaction import redact_columns, redact_json
from riskspark.models import training
from riskspark.models.scoring import load_version, model_versions, save_version, score_batch
from riskspark.operators import profile
from riskspark.operators.contract import CUSTOMER_CONTRACT, typed
from riskspark.operators.monitoring import latency_quantiles
from riskspark.operators.split import exact_split, hash_split, stratum_quotas
from riskspark.sources.manifest import file_checksums, source_manifest
from riskspark.sources.sinks import write_one_file
from riskspark.sources.tables import load_training_table, read_table
from riskspark.streaming import labels, runs, scoring


@pytest.fixture(scope="module")
def snapshot(spark):
    return typed(customers(spark, [customer(i) for i in range(100)]), CUSTOMER_CONTRACT).cache()


@pytest.fixture(scope="module")
def trained(spark, snapshot):
    return training.train_model(snapshot)


def test_split_sizes_and_determinism(spark, snapshot):
    def dealt(parts):
        rows = exact_split(snapshot.repartition(parts), ["customerID"], "Churn")
        return {r["customerID"]: r["split"] for r in rows.collect()}

    first = dealt(1)
    assert first == dealt(7)
    assert [list(first.values()).count(s) for s in ("train", "val", "test")] == [70, 15, 15]
    quotas = {r["stratum"]: (r["test_n"], r["val_n"]) for r in stratum_quotas(snapshot, "Churn").collect()}
    assert sum(q[0] for q in quotas.values()) == 15 and quotas["Yes"][0] in (3, 4)
    loose = hash_split(snapshot, ["customerID"]).groupBy("split").count().collect()
    assert sum(r["count"] for r in loose) == 100


def test_published_test_size(spark):
    rows = spark.range(7043).select(F.col("id"), F.when(F.col("id") < 1869, "Yes").otherwise("No").alias("y"))
    sizes = {r["split"]: r["count"] for r in exact_split(rows, ["id"], "y").groupBy("split").count().collect()}
    assert sizes["test"] == 1057 and sum(sizes.values()) == 7043


def test_logistic_fit_solves_its_objective(spark, trained):
    """Gradient of the penalised loss is zero at the fitted weights."""
    model = trained.model
    train = training.with_label(trained.rows.filter("split = 'train'"), trained.spec)
    from pyspark.ml.functions import vector_to_array

    data = model.transform(train).select(vector_to_array("features").alias("x"), "label").toPandas()
    x, y = np.array(data["x"].tolist()), data["label"].to_numpy()
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) + w).max() < 1e-3
    assert len(training.feature_names(model)) == len(w)


def test_classes_follow_from_probabilities(snapshot, trained):
    rows = training.predict(trained.model, snapshot).collect()
    assert len(rows) == 100 and all(0 <= r["churn_probability"] <= 1 for r in rows)
    # Probabilities are shown with four decimals, so right at the threshold either class may stand.
    assert all(
        r["churn_prediction"] == (r["churn_probability"] >= 0.5) for r in rows if abs(r["churn_probability"] - 0.5) > 1e-4
    )


def test_formula_scores_like_the_pipeline(spark, snapshot, trained):
    fast = score_batch(snapshot, trained.model, threshold=0.3, batch_id="b")
    slow = training.predict(trained.model, snapshot)
    both = fast.join(slow.select("customerID", F.col("churn_probability").alias("want")), "customerID").collect()
    assert len(both) == 100 and all(abs(r["churn_probability"] - r["want"]) < 1e-9 for r in both)
    low = score_batch(snapshot, trained.model, threshold=0.1, batch_id="b")
    assert low.agg(F.sum("predicted_class")).first()[0] >= fast.agg(F.sum("predicted_class")).first()[0]
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            score_batch(snapshot, trained.model, threshold=bad)
    unknown = snapshot.limit(1).withColumn("Contract", F.lit("Never seen"))
    assert score_batch(unknown, trained.model, batch_id="b").count() == 1


def test_importance_and_versions(spark, snapshot, trained, tmp_path):
    bars = training.feature_importance(trained.model, snapshot).collect()
    assert [r["abs_coefficient"] for r in bars] == sorted((r["abs_coefficient"] for r in bars), reverse=True)
    assert all(r["odds_ratio"] == pytest.approx(np.exp(r["coefficient"]), abs=2e-3) for r in bars)
    root = str(tmp_path / "models")
    assert [save_version(spark, trained.model, root) for _ in range(2)] == [1, 2] == model_versions(spark, root)
    assert load_version(spark, root, "latest").stages
    with pytest.raises(ValueError):
        load_version(spark, root, 9)


def test_unknown_model_type():
    with pytest.raises(ValueError):
        training.classifier(training.ModelSpec(kind="Forest"), 10)


def test_profile_of_small_set(spark):
    raw = customers(spark, [customer(i, Churn="Yes" if i < 3 else "No", TotalCharges=" " if i == 0 else str(10.0 * i)) for i in range(10)])
    rows = typed(raw, CUSTOMER_CONTRACT)
    assert tuple(profile.overview(rows, "customerID").first()) == (10, 21, 0, 0)
    gone = {r["column"]: (r["missing_count"], r["missing_percentage"]) for r in profile.column_overview(rows).collect()}
    assert gone["TotalCharges"] == (1, 10.0) and gone["tenure"] == (0, None)
    balance = profile.target_balance(rows, "Churn").first()
    assert (balance["churn_rate"], balance["imbalance_ratio"]) == (0.3, 2.3333)
    summary = {r["feature"]: r for r in profile.numeric_summary(rows).collect()}
    frame = rows.toPandas()
    assert (summary["tenure"]["count"], summary["TotalCharges"]["count"]) == (10, 9)
    for c in ("tenure", "MonthlyCharges", "TotalCharges"):
        s = frame[c].dropna()
        for name, want in (("std", s.std()), ("skewness", s.skew()), ("p25", s.quantile(0.25)), ("p75", s.quantile(0.75))):
            assert summary[c][name] == pytest.approx(want, abs=0.006), (c, name)
    assert profile.correlations(rows).filter("feature_x = feature_y").count() == 3


def test_csv_source_and_manifest(spark, tmp_path):
    path = str(tmp_path / "snapshot.csv")
    names = CUSTOMER_CONTRACT.columns(True)
    rows = [customer(i, TotalCharges="" if i == 3 else "5.5") for i in range(5)]
    text = "\n".join([",".join(names), *[",".join(str(r[n]) for n in names) for r in rows], "", ""])
    (tmp_path / "snapshot.csv").write_text(text)
    loaded = load_training_table(spark, path, CUSTOMER_CONTRACT)
    assert loaded.count() == 5 and loaded.filter("TotalCharges IS NULL").count() == 1
    line = source_manifest(spark, path).first()
    assert line["row_count"] == 5 and line["file_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_training_table(spark, str(tmp_path / "absent.csv"), CUSTOMER_CONTRACT)


def test_csv_drops_and_moves_no_value(spark, tmp_path):
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('x,y\n"a ""q"" b","1,5"\n,2\n')
    assert [tuple(r) for r in read_table(spark, str(quoted), "csv").collect()] == [('a "q" b', "1,5"), (None, "2")]
    surplus = tmp_path / "surplus.csv"
    surplus.write_text("x,y\n1,2\n1,2,3\n")
    for columns in (["x"], ["x", "y"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_table(spark, str(surplus), "csv").select(*columns).collect()
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(folder), "csv").collect()


def test_large_files_are_hashed_in_blocks(spark, tmp_path):
    path = tmp_path / "file.csv"
    path.write_bytes(b"h\n" + b"0123456789\n" * 1000)
    for whole in (1 << 20, 10):
        row = file_checksums(spark, str(path), whole).first()
        assert row["file_sha256"] == hashlib.sha256(path.read_bytes()).hexdigest() and row["file_bytes"] == 11_002


def test_redaction(spark):
    rows = spark.createDataFrame(
        [("C1", {"gender": "F", "k": "1"}, [("a@b", "x")])],
        "customerID string, tags map<string,string>, inner array<struct<Email:string,other:string>>",
    )
    r = redact_columns(rows).first()
    assert r["customerID"] == "[REDACTED]" and r["tags"] == {"gender": "[REDACTED]", "k": "1"}
    assert tuple(r["inner"][0]) == ("[REDACTED]", "x")
    text = spark.createDataFrame([('{"Name": "n", "k": 1}',)], "t string")
    assert text.select(redact_json(F.col("t"))).first()[0] == '{"Name":"[REDACTED]","k":1}'
    deep = spark.createDataFrame([('{"a": [{"email": {"x": 1}}, null], "n": 1.50}',), ("no json",), (None,), ("3",)], "t string")
    assert [r[0] for r in deep.select(redact_json(F.col("t"))).collect()] == ['{"a":[{"email":"[REDACTED]"},null],"n":1.5}', None, None, None]


def test_latency_quantile_inside_a_bucket(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "e", 0.2)] * 10, "ts string, e string, v double")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    row = latency_quantiles(rows, "ts", "v", ["e"], quantiles=(0.5,)).first()
    assert row["p50"] == pytest.approx(0.1 + 0.15 * 0.5)


def test_streams_equal_batches(spark, tmp_path):
    rows = customers(spark, [customer(i, Contract="bad" if i == 4 else "One year") for i in range(12)])
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = runs.file_stream(spark, str(tmp_path / "in"), rows.schema, files_per_trigger=1)
    runs.run_to_files(
        scoring.judge_stream(stream, CUSTOMER_CONTRACT), str(tmp_path / "out"), str(tmp_path / "c1"), ["verdict"]
    )
    counts = {r["verdict"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("verdict").count().collect()}
    assert counts == {"accepted": 11, "rejected": 1}
    keyed = stream.select(F.lit("k").alias("k"), "customerID", "tenure")
    runs.run_per_batch(keyed, labels.latest_log(str(tmp_path / "log"), "k", ["tenure"]), str(tmp_path / "c2"))
    last = labels.latest_rows(spark.read.parquet(str(tmp_path / "log")), "k", ["tenure"]).collect()
    assert [r["tenure"] for r in last] == [11]


def test_entry_and_registry(spark, sf_dir):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 100
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "events", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("g01_average_precision", "g10_capacity_metrics", "h03_ks_statistic", "i03_match_statistics"):
        df = queries[name](spark, sf_dir)
        columns = sorted(df.columns)
        got = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
        result = con.execute(f"SELECT {', '.join(columns)} FROM ({oracles[name]}) q")
        assert got == sorted(tuple(map(str, r)) for r in result.fetchall()), name
    assert entry.entry(spark).count() > 0


def test_one_file_is_put_together_from_sorted_parts(spark, tmp_path):
    """The file has the lines in order, though several tasks sort them."""
    keys = [(7 * i) % 1009 for i in range(1000)] + [5, 5, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k int").repartition(5)
    lines = rows.orderBy("k").select(F.col("k").cast("string").alias("value"))
    with_all = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        file = write_one_file(lines, str(tmp_path / "d"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_all)
    assert len(list((tmp_path / "d" / "parts").glob("part-*"))) > 1
    wanted = "".join(f"{'' if k is None else k}\n" for k in [None, *sorted(k for k in keys if k is not None)]).encode()
    found = file_checksums(spark, file).first()
    assert (found["file_sha256"], found["file_bytes"]) == (hashlib.sha256(wanted).hexdigest(), len(wanted))
