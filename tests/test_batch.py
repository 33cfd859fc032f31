"""The whole batch on CSV files of a random shop."""

from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from checks.compare import mismatch
from checks.views import AS_OF
from stayline.plans import batch, churn, marts
from stayline.plans.batch import load, run_batch
from stayline.plans.scoring import score_batch
from stayline.sources.bucketed import BucketStore
from stayline.sources.publish import Folder, open_version, published
from stayline.sources.staging import checkpoint_root
from stayline.sources.tables import CSV_FILES, date_quality, read_csv_text, typed_and_checked
from tests.csv_shop import write_csv_shop
from tests.test_plans import HOT_KEY_SETTINGS, plan_of, settings
from tests.shops import duckdb_tables, random_shop, sql_rows


def test_batch(spark, tmp_path):
    rows = random_shop(4, orders=400, hot="")
    write_csv_shop(rows, tmp_path / "csv")
    out = tmp_path / "out"
    result = run_batch(
        spark, str(tmp_path / "csv"), str(out), AS_OF, trees=2, max_customers=5, brief_tasks=3
    )

    assert result.unparsed_dates["order_purchase_timestamp"] == 0
    staged = Path(urlparse(checkpoint_root(spark)).path) / "stayline"
    assert not list(staged.glob("batch-*"))
    assert result.table_rows["orders"] == len(rows["orders"])
    assert result.scored_rows == result.feature_rows > 0
    assert 0 <= result.auc <= 1
    assert result.brief_rows <= 5
    assert list(result.mart_shapes) == [
        "page1_executive_overview.csv",
        "page2_sales_product.csv",
        "page3_customer_behavior.csv",
        "page4_churn_intelligence.csv",
    ]
    assert [columns for _, columns in result.mart_shapes.values()] == [11, 14, 16, 17]
    assert result.mart_shapes[marts.CHURN_FILE][0] == result.scored_rows

    out = published(spark, str(out)).path
    assert out == result.path and not result.skipped
    features = spark.read.parquet(f"{out}/customer_features")
    with duckdb_tables(rows) as con:
        assert mismatch(features.toPandas(), sql_rows(con, "customer_features")) is None
    exported = spark.read.option("header", True).csv(f"{out}/marts/{marts.SALES_FILE}")
    assert exported.count() == result.mart_shapes[marts.SALES_FILE][0]
    model = churn.load_model(f"{out}/churn_model")
    assert churn.score(model, features).count() == result.feature_rows


def marts_of(spark, out):
    found = published(spark, out)
    read = lambda file: spark.read.option("header", True).csv(f"{found.path}/marts/{file}")
    return {file: sorted(map(str, read(file).collect())) for file in (marts.SALES_FILE, marts.CHURN_FILE)}


def test_a_failed_run_hides_nothing_and_goes_on(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    write_csv_shop(random_shop(4, orders=200, hot=""), tmp_path / "old")
    write_csv_shop(random_shop(5, orders=300, hot=""), tmp_path / "new")
    run = lambda folder: run_batch(spark, str(tmp_path / folder), out, AS_OF, trees=2, max_customers=5)
    run("old")
    before, old = published(spark, out), marts_of(spark, out)

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(churn, "score", killed)
    with pytest.raises(KeyboardInterrupt):
        run("new")
    assert published(spark, out).path == before.path and marts_of(spark, out) == old
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stayline_")]
    monkeypatch.undo()

    # The rerun neither loads nor trains: both would fail now.
    monkeypatch.setattr(batch, "load", killed)
    monkeypatch.setattr(churn, "train", killed)
    again = run("new")
    assert again.skipped == ("tables", "features", "model")
    assert published(spark, out).path == again.path != before.path
    monkeypatch.undo()

    # Nothing of it differs from a run that never failed.
    clean = str(tmp_path / "clean")
    whole = run_batch(spark, str(tmp_path / "new"), clean, AS_OF, trees=2, max_customers=5)
    assert not whole.skipped and marts_of(spark, clean) == marts_of(spark, out) != old
    assert (whole.table_rows, whole.unparsed_dates, whole.mart_shapes) == (
        again.table_rows, again.unparsed_dates, again.mart_shapes,
    )


def test_versions(spark, tmp_path):
    out = str(tmp_path / "out")
    assert published(spark, out) is None
    first = open_version(spark, out, {"a": 1})
    assert open_version(spark, out, {"a": 1}).name == first.name != open_version(spark, out, {"a": 2}).name
    assert first.stage("one", lambda: {"n": 1}) == {"n": 1}
    with pytest.raises(ZeroDivisionError):
        first.stage("two", lambda: {"n": 1 / 0})
    again = open_version(spark, out, {"a": 1})
    assert again.stage("one", lambda: 1 / 0) == {"n": 1} and again.skipped == ["one"]
    assert again.stage("two", lambda: {"n": 2}) == {"n": 2}
    assert published(spark, out) is None
    again.publish()
    assert published(spark, out).name == first.name and published(spark, out).stages() == ["one", "two"]
    # A published version is not written again; of older ones, only the last stay.
    names = [first.name]
    for _ in range(3):
        v = open_version(spark, out, {"a": 1})
        v.publish(keep=2)
        names.append(v.name)
    assert len(set(names)) == 4 and published(spark, out).name == names[-1]
    left = Folder(spark, out).names("versions")
    assert set(names[-2:]) <= set(left) and not set(names[:2]) & set(left)
    assert len(left) == 3  # the unpublished one of {"a": 2} is not old enough
    published(spark, out).publish(abandoned_days=0)
    assert set(Folder(spark, out).names("versions")) == set(names[-2:])
    # A commit cut off while it was written does not count, and is not written over.
    (tmp_path / "out/commits/00000009.json").write_text('{"version": "')
    assert published(spark, out).name == names[-1]
    with pytest.raises(FileExistsError):
        Folder(spark, out).create("commits/00000009.json", {})


def test_new_inputs_or_parameters_start_a_new_version(spark, tmp_path):
    write_csv_shop(random_shop(4, orders=20, hot=""), tmp_path / "csv")
    files = Folder(spark, str(tmp_path / "csv"))
    before = files.listing()
    assert [f[0] for f in before] == sorted(f"/{f}" for f in CSV_FILES.values())
    (tmp_path / "csv/_hidden").write_text("x")
    assert files.listing() == before == json.loads(json.dumps(before))
    with open(tmp_path / "csv" / CSV_FILES["sellers"], "a") as out:
        out.write("s3\n")
    assert files.listing() != before


def test_dates_are_checked_in_the_pass_that_loads(spark, tmp_path):
    rows = random_shop(4, orders=50, hot="")
    write_csv_shop(rows, tmp_path / "csv")
    path = tmp_path / "csv" / CSV_FILES["orders"]
    lines = path.read_text().splitlines()
    cells = lines[3].split(",")
    cells[3] = "never"
    path.write_text("\n".join([*lines[:3], ",".join(cells), *lines[4:]]) + "\n")
    raw = read_csv_text(spark, str(path))
    want = {r["date_column"]: r["unparsed_values"] for r in date_quality(raw).collect()}
    table, _ = typed_and_checked(raw)
    assert table._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    counts, unparsed = load(spark, str(tmp_path / "csv"), str(tmp_path / "tables"))
    assert unparsed == want and unparsed["order_purchase_timestamp"] == 1
    assert counts["orders"] == len(rows["orders"])


def test_scoring_alone_uses_the_published_model(spark, tmp_path, monkeypatch):
    write_csv_shop(random_shop(4, orders=300, hot=""), tmp_path / "csv")
    batch_out, out = str(tmp_path / "batch"), str(tmp_path / "scores")
    with pytest.raises(FileNotFoundError):
        score_batch(spark, batch_out, str(tmp_path / "csv"), out, AS_OF)
    run_batch(spark, str(tmp_path / "csv"), batch_out, AS_OF, trees=2, max_customers=5)
    monkeypatch.setattr(churn, "train", None)
    score_batch(spark, batch_out, str(tmp_path / "csv"), out, AS_OF)
    read = lambda root: sorted(map(str, spark.read.parquet(f"{published(spark, root).path}/customer_scores").collect()))
    assert read(out) == read(batch_out)


def deliveries(rows, first: set, changed: set):
    """The shop as a first delivery of ``first`` orders, some of them differing, and all rows of ``changed``."""
    of_orders = ("orders", "order_items", "payments", "reviews")
    whole, delta = {}, {}
    for name, body in rows.items():
        if name not in of_orders:
            whole[name] = delta[name] = body
            continue
        at = 0  # order_id is the first column of all four
        whole[name] = [r for r in body if r[at] in first]
        delta[name] = [r for r in body if r[at] in changed]
    # What the first delivery said of the changed orders was different.
    whole["reviews"] = [r for r in whole["reviews"] if r[0] not in changed]
    whole["orders"] = [(*r[:2], "shipped", *r[3:]) if r[0] in changed else r for r in whole["orders"]]
    whole["payments"] += [(o, "voucher", 7) for o in sorted(changed & first)]
    return whole, delta


def test_changed_orders_give_the_results_of_a_whole_run(spark, tmp_path):
    rows = random_shop(6, orders=400, hot="")
    ids = [f"o{i}" for i in range(400)]
    # The second delivery has new and changed orders, the third changes some of these again.
    second, third = {*ids[370:385], "o1", "o7", "o25"}, {*ids[380:400], "o7", "o371"}
    whole, _ = deliveries(rows, set(ids[:370]), second | third)
    _, two = deliveries(rows, set(), second)
    two["reviews"] = [r for r in two["reviews"] if r[0] not in third]
    _, three = deliveries(rows, set(), third)
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        write_csv_shop(whole, tmp_path / "csv0")
        run_batch(spark, str(tmp_path / "csv0"), out, AS_OF, trees=1, changes_only=True)
    run_batch(spark, str(tmp_path / "csv0"), out, AS_OF, trees=1)
    names = [published(spark, out).name]
    for i, delta in enumerate((two, three)):
        write_csv_shop(delta, tmp_path / f"csv{i + 1}")
        run_batch(spark, str(tmp_path / f"csv{i + 1}"), out, AS_OF, trees=1, keep=1, changes_only=True)
        found = published(spark, out)
        assert found.uses() == names
        names.append(found.name)
        # Only the delivery's own rows are written.
        for name in ("order_lines", "purchases"):
            assert [n for n in found.folder.names(f"versions/{found.name}/base/{name}") if "=" in n] == [f"delivery={i + 1}"]
    # The versions whose files are read stay, though one version is kept.
    assert Folder(spark, out).names("versions") == sorted(names)

    everything = {n: [r for r in body if r[0] in set(ids)] if n in ("orders", "order_items", "payments", "reviews") else body for n, body in rows.items()}
    write_csv_shop(everything, tmp_path / "all")
    clean = str(tmp_path / "clean")
    run_batch(spark, str(tmp_path / "all"), clean, AS_OF, trees=1)
    read = lambda root, name: sorted(map(str, spark.read.parquet(f"{published(spark, root).path}/{name}").collect()))
    assert read(out, "customer_features") == read(clean, "customer_features")
    assert read(out, "sales_facts") == read(clean, "sales_facts")
    csv_rows = lambda root, file: sorted(
        map(str, spark.read.option("header", True).csv(f"{published(spark, root).path}/marts/{file}").collect())
    )
    for file in (marts.EXECUTIVE_FILE, marts.SALES_FILE, marts.BEHAVIOR_FILE):
        assert csv_rows(out, file) == csv_rows(clean, file) != []


def test_later_deliveries_hide_earlier_rows_without_a_shuffle(spark, tmp_path):
    def store(number, changed=None):
        path = lambda n: str(tmp_path / f"base{n}")
        return BucketStore(spark, path(number), "k", 4, number, path(number - 1) if changed else None, changed)

    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    opened = [store(0)]
    assert opened[0].keep("t", lambda: frame([("a", 1), ("a", 2), ("b", 3), (None, 4)])).count() == 4
    # A delivery without rows for a table still hides what it replaces; the next number goes on.
    opened.append(store(1, lambda: frame([("a", 0), ("c", 0)])))
    assert sorted(map(str, opened[1].keep("t", lambda: frame([])).collect())) == ["Row(k='b', v=3)", "Row(k=None, v=4)"]
    opened.append(store(2, lambda: frame([("b", 0), ("d", 0)])))
    with settings(spark, **HOT_KEY_SETTINGS):
        t = opened[2].keep("t", lambda: frame([("b", 5), ("d", 6)]))
        summed = t.groupBy("k").agg(F.sum("v").alias("v"))
        assert sorted(map(str, summed.collect())) == ["Row(k='b', v=5)", "Row(k='d', v=6)", "Row(k=None, v=4)"]
        assert "Exchange" not in plan_of(summed) and "LeftAnti" in plan_of(summed)
    for s in opened:
        s.close()
    with pytest.raises(ValueError):
        BucketStore(spark, str(tmp_path / "x"), "k", 4, 1)
