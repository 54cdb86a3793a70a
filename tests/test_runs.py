"""Whole runs over the layers, re-runs, and incremental ingest."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfmark import schemas
from shelfmark.plans import normalise, pipeline
from shelfmark.sources import exports, layers, objects
from shelfmark.streaming import ingest
from test_geocode import HIT
from test_pages import CARDS, QUOTES
from test_quality import partners


@pytest.fixture(scope="module")
def inputs(spark):
    page = "page_id bigint, url string, category string, category_no int, html string"
    books = [(i, "http://site.org/catalogue/category/c_2/index.html", c, i, CARDS) for i, c in enumerate(["Travel", "Art", "Music"])]
    quotes = [(i, "http://q.org/", i + 1, QUOTES) for i in range(3)]
    shops = partners(spark, {"adresse": "20 Avenue", "ville": "Paris", "code_postal": "75007"}, {"ville": None})
    return pipeline.Inputs(
        spark.createDataFrame(books, page),
        spark.createDataFrame(quotes, "page_id bigint, url string, page_no int, html string"),
        shops.drop("row_number"),
        spark.createDataFrame([("20 avenue|paris|75007", HIT)], "key string, body string"),
    )


def settings(root, **kw):
    return pipeline.Settings(root=str(root), salt="s", book_site="http://site.org", quote_site="http://q.org", **kw)


def counts(run):
    return {(r.entity, r.stage): r.n_rows for r in run.summary().collect()}


def test_run_rerun_and_reports(spark, tmp_path, inputs):
    first = pipeline.Run(spark, settings(tmp_path), "b1")
    first.run(inputs)
    # one card per page is priced "N/A" and leaves at transform; two quotations repeat
    assert counts(first) == {
        ("books", "extracted"): 6, ("books", "transformed"): 3, ("books", "loaded"): 3,
        ("quotes", "extracted"): 6, ("quotes", "transformed"): 2, ("quotes", "loaded"): 2,
        ("librairies", "extracted"): 1, ("librairies", "transformed"): 1, ("librairies", "loaded"): 1,
    }
    gold = pipeline.gold_tables(spark, str(tmp_path))
    assert rows(gold["dim_tags"], "tag_name", "usage_count") == [("x", 1), ("y", 1)]
    shop = gold["dim_librairies"].first()
    assert (float(shop.latitude), shop.ville) == (48.850699, "Paris")
    rejected = [("extract_books", 3), ("import_shops", 1), ("transform_books", 3)]
    assert rows(first.quarantine().groupBy("stage").count()) == rejected
    assert first.failures().count() == 5

    # a repeated load of the same batch replaces its rows; a new batch adds books, not quotations
    first.load()
    assert pipeline.gold_tables(spark, str(tmp_path))["fact_books"].count() == 3
    assert rows(first.quarantine().groupBy("stage").count()) == rejected
    second = pipeline.Run(spark, settings(tmp_path), "b2")
    second.run(inputs)
    gold = pipeline.gold_tables(spark, str(tmp_path))
    sizes = {name: df.count() for name, df in gold.items()}
    assert sizes == {
        "dim_categories": 3, "fact_books": 6, "dim_authors": 2, "dim_tags": 2,
        "fact_quotes": 2, "quote_tags": 2, "dim_librairies": 2,
    }
    assert gold["fact_books"].select("book_id").distinct().count() == 6
    reports = pipeline.run_reports(spark, str(tmp_path))
    assert reports["dashboard"].first().total_livres == 6
    assert spark.table("v_stats_categories").count() == 3


def test_replacing_run_keeps_every_stage_of_the_quarantine(spark, tmp_path, inputs):
    run = pipeline.Run(spark, settings(tmp_path, replace_batch=True), "b1")
    for _ in range(2):
        run.extract(inputs)
    assert run.quarantine().select("stage").distinct().count() == 2
    assert [r.n_rows for r in run.summary().filter("entity = 'books'").collect()] == [6, 6]


def test_trial_run_is_capped(spark, tmp_path, inputs):
    run = pipeline.Run(spark, settings(tmp_path).trial())
    run.extract(inputs)
    assert counts(run)[("books", "extracted")] == 4
    assert counts(run)[("quotes", "extracted")] == 4


def test_stream_takes_each_file_once(spark, tmp_path):
    def drop(texts, start):
        data = [(t, "A", None, ["x"], start + i) for i, t in enumerate(texts)]
        df = spark.createDataFrame(data, "text string, author string, author_url string, tags array<string>, position bigint")
        stamp = F.struct(F.lit("s").alias("source"), F.current_timestamp().alias("scraped_at"), F.lit("b").alias("batch_id"), F.lit("1.0").alias("pipeline_version"))
        df.withColumn("_metadata", stamp).write.mode("append").parquet(str(tmp_path / "landing"))

    for texts in (["a", "b"], ["B ", "c"], None):
        if texts:
            drop(texts, 10)
        ingest.ingest_quotes(spark, settings(tmp_path), str(tmp_path / "landing"), str(tmp_path / "state")).awaitTermination()
    gold = pipeline.gold_tables(spark, str(tmp_path))
    assert rows(gold["fact_quotes"], "quote_text") == [("a",), ("b",), ("c",)]
    assert gold["dim_authors"].first().quote_count == 3


def test_normalised_tables(spark):
    data = [(3, "q3", "B", ["y"]), (1, "q1", "A", ["x", "y", "x"]), (2, "q2", "A", [])]
    t = normalise.normalise_quotes(spark.createDataFrame(data, "position bigint, text string, author string, tags array<string>"))
    assert rows(t["authors"]) == [(1, "A"), (2, "B")]
    assert rows(t["quotes"]) == [(1, "q1", 1), (2, "q2", 1), (3, "q3", 2)]
    assert rows(t["tags"]) == [(1, "x"), (2, "y")]
    assert rows(t["quotes_tags"]) == [(1, 1), (1, 2), (3, 2)]
    df = partners(spark, {}, {}).drop("row_number").withColumn("latitude", F.lit(1.0)).withColumn("longitude", F.lit(2.0))
    shops = normalise.normalise_shops(df)
    tables = normalise.shop_tables(shops)
    assert tables["librairies"].count() == tables["ca_annuel"].count() == 1
    assert "ca_annuel" not in tables["librairies"].columns and "contact_nom" not in tables["librairies"].columns


def test_exports_and_objects(spark, tmp_path):
    df = spark.createDataFrame([("A/b C", bytearray(b"img"), None)], "title string, image binary, note string")
    images = exports.image_table(df)
    exports.write_image_files(images, str(tmp_path / "images"))
    listed = objects.list_images(spark, str(tmp_path)).first()
    assert (listed.name, listed.size) == ("a_b_c.jpeg", 3)
    assert bytes(objects.read_objects(spark, str(tmp_path), "images", "a_b_c.jpeg").first().content) == b"img"
    exports.export_json(df.drop("image"), str(tmp_path / "exports"), "books")
    exports.backup(df, str(tmp_path / "backups"))
    stats = {r.bucket: r.n_objects for r in objects.storage_stats(spark, str(tmp_path)).collect()}
    assert set(stats) == {"exports", "backups"} and min(stats.values()) >= 1
    plan = objects.list_images(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_raw_documents_keep_broken_lines_apart(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"title": "a", "price": "1"}\n{broken\n')
    docs = layers.read_documents(spark, str(tmp_path), schemas.RAW_BOOKS).cache()
    assert docs.filter("_corrupt_record is not null").count() == 1
    assert docs.filter("title = 'a'").count() == 1


def test_repeated_extract_adds_nothing_and_pages_may_have_large_ids(spark, tmp_path, inputs):
    far = inputs.quote_pages.withColumn("page_id", F.col("page_id") + (1 << 40))
    run = pipeline.Run(spark, settings(tmp_path), "b1")
    for _ in range(2):
        run.extract(pipeline.Inputs(quote_pages=far))
    assert [r.n_rows for r in run.summary().collect()] == [6, 6]
    run.transform()
    assert run._silver("clean_quotes", schemas.CLEAN_QUOTES).count() == 2


def test_erasure_reaches_every_stored_layer(spark, tmp_path):
    shops = partners(spark, {"contact_email": "gone@x.org", "contact_nom": "Gone Person"}, {"contact_email": "here@x.org", "contact_nom": "Else"})
    checkpoints = tmp_path / "root"
    run = pipeline.Run(spark, settings(checkpoints), "b1")
    run.run(pipeline.Inputs(partners=shops.drop("row_number")))
    # raw contacts wait in no folder once a stage is over
    assert not (checkpoints / "import" / "b1").exists()
    asked = [("email", " gone@x.org "), ("email", "nobody@x.org"), ("fax", "gone@x.org"), ("nom", "")]
    requests = spark.createDataFrame(asked, "identifier_type string, identifier string")
    log = pipeline.erase_layers(spark, str(checkpoints), requests, salt="s")
    assert sorted((r.identifier_type, r.status) for r in log.collect()) == [
        ("email", "completed"), ("email", "not_found"), ("fax", "unknown_type"), ("nom", "not_found"),
    ]
    bronze = layers.read_layer(spark, str(checkpoints), "bronze", "raw_librairies", schemas.RAW_SHOPS)
    assert rows(bronze, "contact_email") == [("here@x.org",)]
    known = layers.read_layer(spark, str(checkpoints), "silver", "identity_map", pipeline.IDENTITY)
    assert known.select("contact_hash").distinct().count() == 1
    assert layers.read_gold(spark, str(checkpoints), "dim_librairies", schemas.GOLD["dim_librairies"]).count() == 1
    assert run._silver("clean_librairies", schemas.CLEAN_SHOPS).count() == 1
    # repeating a later stage brings nobody back
    run.transform()
    assert run._silver("clean_librairies", schemas.CLEAN_SHOPS).count() == 1
    for path in checkpoints.rglob("*.parquet"):
        assert b"gone@x.org" not in path.read_bytes()
    again = pipeline.erase_layers(spark, str(checkpoints), requests, salt="s")
    assert again.filter("status = 'completed'").count() == 0
