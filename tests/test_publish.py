import json
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import line, lines_frame, rows

from tillspark.operators.checks import IntegrityError
from tillspark.operators.quality import QualityGateError
from tillspark.plans.refresh import refresh_files, semantic_from_published
from tillspark.settings import Adoption, Extract, Quality, Recommend, Settings
from tillspark.sources import published
from tillspark.sources.published import PublishError
from tillspark.sources.records import FeedContractError
from tillspark.sources.staging import shared_folder


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_a_version_becomes_visible_whole(spark, folder):
    assert published.read_manifest(spark, folder) is None
    published.publish(spark, folder, "night", {"a": table(spark, 1), "b": table(spark, 2, 3)})
    assert rows(published.read_published(spark, folder, "b")) == [(2,), (3,)]
    manifest = published.publish(spark, folder, "night", {"a": table(spark, 9)})
    # A retried run writes beside the version that is being read, and retires b.
    assert manifest["version"] == "night__2" and manifest["retired"] == ["b"]
    assert rows(published.read_published(spark, folder, "a")) == [(9,)]
    assert rows(spark.read.parquet(f"{folder}/runs/night/a")) == [(1,)]
    with pytest.raises(PublishError, match="b is not"):
        published.read_published(spark, folder, "b")


def test_a_failed_write_leaves_the_old_version(spark, folder):
    published.publish(spark, folder, "one", {"a": table(spark, 1)})
    broken = table(spark, 1).selectExpr("v", "raise_error('boom') as x")
    with pytest.raises(Exception, match="boom"):
        published.publish(spark, folder, "two", {"a": table(spark, 2), "b": broken})
    assert published.read_manifest(spark, folder)["version"] == "one"


def test_incomplete_or_unreadable_versions_are_refused(spark, folder):
    published.publish(spark, folder, "one", {"a": table(spark, 1)})
    published.verify_version(spark, folder, "one", {"a": 1})
    with pytest.raises(PublishError, match="holds 1 rows"):
        published.verify_version(spark, folder, "one", {"a": 2})
    with pytest.raises(PublishError, match="missing"):
        published.verify_version(spark, folder, "one", {"a": 1, "b": 1})
    for part in Path(folder, "runs/one/a").glob("*.parquet"):
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(b"not parquet")
    with pytest.raises(PublishError, match="cannot be read"):
        published.verify_version(spark, folder, "one", {"a": 1})


@pytest.mark.parametrize("run_id", ["", "..", ".hidden", "a/b", "../x", "a b"])
def test_run_ids_cannot_leave_their_folder(spark, folder, run_id):
    with pytest.raises(ValueError, match="cannot name"):
        published.publish(spark, folder, run_id, {"a": table(spark, 1)})


def test_a_manifest_pointing_elsewhere_is_refused(spark, folder):
    Path(folder, published.MANIFEST).write_text(json.dumps({"version": "../x", "tables": {"a": 1}}))
    with pytest.raises(PublishError, match="unusable"):
        published.read_published(spark, folder, "a")


def test_csv_export_writes_days(spark, folder):
    frame = lines_frame(spark, [line("1", "A")]).selectExpr("invoice_no", "invoice_ts as Date")
    published.export_csv({"t": frame}, folder)
    (part,) = Path(folder, "t").glob("*.csv")
    assert part.read_text().splitlines() == ["invoice_no,Date", "1,2011-03-01"]


def test_files_to_published_tables_to_semantic_star(spark, folder):
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    feed = [header]
    for i in range(40):
        pair = (("M1", "RED MUG"), ("M2", "BLUE MUG")) if i % 2 else (("M3", "RED CUP"), ("M4", "BLUE CUP"))
        feed += [f"{i},{c},{d},2,3/{1 + i % 28}/2011 9:05,1.25,{i % 7 + 1},France" for c, d in pair]
    feed += ["900,M5,GREEN MUG,1,3/1/2011 9:05,4.5,,Spain", "C901,M1,RED MUG,-1,3/1/2011 9:05,1.25,1,France"]
    lines, events = Path(folder, "lines.csv"), Path(folder, "usage.csv")
    lines.write_text("\n".join(feed) + "\n")
    events.write_text(
        "event_ts,user_id,team,event_type,stock_code,feedback_score\n"
        "2026-04-06 09:00:00,u1,Ops,view,M1,\n2026-04-06 09:01:00,u1,Ops,apply,M1,\n"
    )
    settings = Settings(
        recommend=Recommend(min_support_count=5), adoption=Adoption(roster={"Ops": 2}),
        quality=Quality(max_quarantine_rate=0.2),
    )
    root = f"{folder}/out"
    manifest = refresh_files(spark, str(lines), str(events), root, "r1", settings)
    figures = manifest["metrics"]
    assert (figures["rows_source"], figures["rows_quarantined"], figures["rows_loaded"]) == (82, 1, 81)
    assert figures["products"] == 5 and figures["reach_pct"] == 50.0
    assert figures["catalogue_coverage_pct"] == 100.0
    assert figures["inputs"]["lines"][0] == 82 and manifest["tables"]["quarantine"] == 1
    recs = published.read_published(spark, root, "recommendations")
    assert rows(recs.where("stock_code = 'M1'"), "recommended_stock_code", "lift") == [("M2", 2.05)]
    offered = recs.where("stock_code = 'M5'").orderBy("rank").first()
    assert offered["method"] == "content_tfidf" and offered["lift"] is None
    model = semantic_from_published(spark, root, settings, export=f"{folder}/semantic")
    assert model["fact_sales"].count() == 81 and model["dim_product"].count() == 6
    exported = spark.read.csv(f"{folder}/semantic/fact_sales", header=True)
    assert exported.count() == 81 and exported.first()["Date"].startswith("2011-03-")
    assert len(list(Path(folder, "semantic").iterdir())) == 9
    assert manifest["tables"]["quality_results"] == 9
    assert set(manifest["tables"]) >= {"dim_customer", "dim_date", "quarantine", "fact_sales"}
    # A failing gate leaves its results and the published version.
    strict = Settings(quality=Quality(max_quarantine_rate=0.0), adoption=settings.adoption)
    with pytest.raises(QualityGateError):
        refresh_files(spark, str(lines), str(events), root, "r2", strict)
    assert spark.read.parquet(f"{root}/failed/r2/quality_results").count() == 9
    assert published.read_manifest(spark, root)["version"] == "r1"
    # Staged tables of a run are gone when it ends.
    staged = Path(shared_folder(spark).removeprefix("file:"), spark.sparkContext.applicationId)
    assert not list(staged.glob("run-*"))
    # Records that cannot be read stop a run, unless a share of them is allowed.
    Path(folder, "broken.csv").write_text("\n".join([*feed, "1,M1,RED MUG"]) + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        refresh_files(spark, f"{folder}/broken.csv", str(events), root, "r2", settings)
    for limit in (0.001, 0.05):
        allowed = replace(settings, extract=Extract(max_reject_rate=limit))
        if limit < 0.01:
            with pytest.raises(FeedContractError, match="broken.csv \\(1\\)"):
                refresh_files(spark, f"{folder}/broken.csv", str(events), root, "r2", allowed)
            continue
        kept = refresh_files(spark, f"{folder}/broken.csv", str(events), root, "r2", allowed)
    assert kept["tables"]["rejected_records"] == 1 and kept["metrics"]["rows_source"] == 82
    assert [*kept["metrics"]["rejected"].values()] == [1]
    assert published.read_published(spark, root, "rejected_records").first()["record"] == "1,M1,RED MUG"
    # A published table that holds a product twice breaks the star.
    published.publish(spark, root, "r3", {
        **{n: published.read_published(spark, root, n) for n in ("fact_sales", "dim_customer", "quarantine")},
        "dim_product": published.read_published(spark, root, "dim_product").unionByName(
            published.read_published(spark, root, "dim_product").limit(1)),
    })
    with pytest.raises(IntegrityError, match="dim_product"):
        semantic_from_published(spark, root, settings)
