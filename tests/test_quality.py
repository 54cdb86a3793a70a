"""Validation, contracts, privacy and erasure."""

import hashlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfmark import schemas
from shelfmark.operators import cleaning, privacy, validation
from shelfmark.sources import layers, partner

SALT = "salt"
GOOD = ("Le Port", "1 rue A", "75004", "paris", "Ana B", "ana@b.org", "0142789012", "120000", "2020-01-15", "Art")


def partners(spark, *changes):
    data = []
    for i, change in enumerate(changes):
        row = dict(zip(schemas.PARTNER_COLUMNS, GOOD, strict=True)) | change
        data.append((i + 2, *[row[c] for c in schemas.PARTNER_COLUMNS]))
    return spark.createDataFrame(data, "row_number bigint, " + schemas.PARTNER_FILE)


@pytest.fixture(scope="module")
def mixed(spark):
    return partners(
        spark,
        {},
        {"contact_telephone": "142789012", "contact_nom": None},
        {"contact_telephone": "01 42.78-90.12", "ca_annuel": None},
        {"nom_librairie": None, "code_postal": "7500"},
        {"contact_email": "bad@mail"},
        {"code_postal": None, "ville": ""},
    )


def test_valid_and_invalid_rows_add_up(mixed):
    good, bad = validation.validate_partners(mixed, batch_id="b")
    assert [r[0] for r in rows(good, "row_number")] == [2, 3, 4]
    assert rows(bad, "key", "reason") == sorted([
        ("5", "Ligne 5: nom_librairie manquant"), ("5", "Ligne 5: code_postal invalide"),
        ("6", "Ligne 6: email invalide"),
        ("7", "Ligne 7: code_postal invalide"), ("7", "Ligne 7: ville manquante"),
    ], key=repr)
    assert tuple(validation.import_stats(mixed).first()) == (6, 3, 3, 3, 5)
    summary = validation.error_summary(bad, shown=2).collect()
    assert summary[-1].message == "... et 3 autres"
    padded = validation.validate_partners(mixed, batch_id="b", pad_postcode=True).quarantine
    assert padded.filter("reason like '%code_postal%'").count() == 1


def test_no_identifier_reaches_silver_or_the_error_list(mixed):
    good, bad = validation.validate_partners(mixed, batch_id="b")
    silver, bronze = privacy.import_partners(good, source="s", batch_id="b", salt=SALT)
    text = str(silver.collect()) + str(bad.collect())
    assert "ana@b.org" not in text and "bad@mail" not in text and "Ana B" not in text
    first = silver.filter("_metadata.row_number = 2").first()
    assert first.contact_hash == hashlib.sha256(b"salt:Ana B|ana@b.org|0142789012").hexdigest()
    assert (first.ca_annuel_range, first._metadata.anonymized) == ("100k€ - 250k€", True)
    raw = privacy.silver_partners(bronze, salt=SALT, anonymize=False)
    assert "contact_email" in raw.columns and "nom" in raw.columns
    shop = cleaning.clean_shops(silver, source="s", batch_id="b").first()
    assert (shop.ville, str(shop.date_partenariat)) == ("Paris", "2020-01-15")


def test_contract_keys_and_references(spark):
    df = spark.createDataFrame(
        [("a" * 6, 0, 1.0), (None, 6, 12345678.9), ("ok", None, None)], "t string, r int, p double"
    )
    rules = [
        validation.Rule("t", required=True, max_length=5),
        validation.Rule("r", low=1, high=5),
        validation.Rule("p", decimal=(10, 2)),
    ]
    got = rows(validation.contract_report(df, rules))
    assert got == [("r: above 5", 1), ("r: below 1", 1), ("t: longer than 5", 1), ("t: required", 1)]
    assert validation.contract_report(df, [validation.Rule("p", decimal=(8, 2))]).count() == 1
    split = validation.enforce_contract(df, rules, stage="s", key="t", batch_id="b")
    assert (split.good.count(), split.quarantine.count()) == (1, 2)
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(validation.duplicate_keys(child, ["k"])) == [(1, 2)]
    assert rows(validation.orphans(child, "k", child.filter("k = 1"), "k")) == [(2,)]


def test_fill_defaults_comes_before_text_casts(spark):
    df = partners(spark, dict.fromkeys(schemas.PARTNER_COLUMNS)).drop("row_number")
    df = df.withColumn("latitude", F.lit(None).cast("double")).withColumn("longitude", F.lit(2.5))
    row = cleaning.fill_defaults(df, F.lit("2024-01-01").cast("date")).first()
    assert (row.code_postal, row.contact_telephone, row.nom_librairie) == ("00000", "0000000000", "Unknown")
    assert (float(row.ca_annuel), row.latitude, row.longitude) == (0.0, 0.0, 2.5)
    assert str(row.date_partenariat) == "2024-01-01"


def imported(spark, root, ages, now):
    df = partners(spark, *[{"contact_nom": f"P{i}"} for i in range(len(ages))])
    bronze = privacy.bronze_partners(df, source="s", batch_id="b")
    when = F.lit(None).cast("timestamp")
    for i, age in enumerate(ages):
        if age is not None:
            when = F.when(F.col("contact_nom") == f"P{i}", F.lit(now - timedelta(days=age))).otherwise(when)
    return bronze.withColumn("_metadata", F.col("_metadata").withField("imported_at", when))


def test_purge_rewrites_only_batches_with_expired_rows(spark, tmp_path):
    now, root = datetime(2024, 3, 1), str(tmp_path)
    rows_in = imported(spark, root, [29, 30, 31, None], now)
    layers.append_layer(rows_in, root, layers.BRONZE, "raw_librairies", "mixed")
    layers.append_layer(rows_in.filter("contact_nom = 'P2'"), root, layers.BRONZE, "raw_librairies", "old")
    layers.append_layer(rows_in.filter("contact_nom = 'P0'"), root, layers.BRONZE, "raw_librairies", "new")

    def read():
        return layers.read_layer(spark, root, layers.BRONZE, "raw_librairies", schemas.RAW_SHOPS)

    untouched = sorted(p.name for p in (tmp_path / "bronze/raw_librairies/batch_id=new").iterdir())
    assert privacy.purge_layer(read(), root, "raw_librairies", now) == 2
    assert rows(read(), "batch_id", "contact_nom") == [
        ("mixed", "P0"), ("mixed", "P1"), ("mixed", "P3"), ("new", "P0"),
    ]
    assert sorted(p.name for p in (tmp_path / "bronze/raw_librairies/batch_id=new").iterdir()) == untouched
    assert privacy.purge_layer(read(), root, "raw_librairies", now) == 0


def test_erasure_reaches_every_layer_even_after_a_purge(spark):
    df = partners(spark, {}, {"contact_nom": "Bo", "contact_email": "bo@b.org"}, {"contact_nom": "Cy", "contact_email": "cy@b.org"})
    silver, bronze = privacy.import_partners(df, source="s", batch_id="b", salt=SALT)
    requests = spark.createDataFrame(
        [("email", "bo@b.org"), ("nom", "Nobody")], "identifier_type string, identifier string"
    )
    done = privacy.erase(bronze, silver, silver, requests, salt=SALT)
    assert tuple(done.counts.first()) == (1, 1, 1)
    assert done.bronze.filter("contact_email = 'bo@b.org'").isEmpty()
    assert done.silver.count() == done.gold.count() == 2
    log = done.log.filter("identifier_type = 'email'").first()
    assert log.identifier_hash == hashlib.sha256(b"salt:bo@b.org").hexdigest()[:16] + "..."
    known = privacy.identity_map(bronze, SALT)
    late = privacy.erase(bronze.limit(0), silver, silver, requests, salt=SALT, known=known)
    assert tuple(late.counts.first()) == (0, 1, 1)


def test_partner_files_keep_zeros_and_report_columns(spark, tmp_path):
    df = partners(spark, {"code_postal": "01000"}).drop("row_number")
    df.write.option("header", True).csv(str(tmp_path / "shops"))
    sheets = partner.read_partner(spark, str(tmp_path))
    assert sheets["shops"].first().code_postal == "01000"
    assert partner.check_partner_columns(sheets["shops"]).ok
    odd = sheets["shops"].drop("ville").withColumn("extra", F.lit("x")).limit(0)
    check = partner.check_partner_columns(odd)
    assert len(check.errors) == 2 and len(check.warnings) == 1
    assert not partner.check_partner_path(spark, str(tmp_path / "none.csv")).ok


def test_keep_first_with_repeated_positions(spark):
    from shelfmark.operators.cleaning import keep_first

    df = spark.createDataFrame([("C", 0, "x"), ("X", 1, "y"), ("C", 1, "z"), ("C", 0, "x"), (None, 5, "n")], "k string, o int, v string")
    got = sorted((r.k or "", r.o) for r in keep_first(df, "k", "o").collect())
    assert got == [("", 5), ("C", 0), ("X", 1)]


def test_retention_filter_reaches_the_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    from shelfmark.operators.privacy import purge_expired

    spark.sql("select timestamp'2024-01-01 00:00:00' as at union all select null").write.parquet(f"{tmp_path}/t")
    kept = purge_expired(spark.read.parquet(f"{tmp_path}/t"), F.lit("2024-06-01").cast("timestamp"), 30, "at")
    assert [r.at for r in kept.collect()] == [None]
    assert "PushedFilters: [Or(IsNull(at),GreaterThanOrEqual(at" in kept._jdf.queryExecution().executedPlan().toString()


def test_replacing_a_batch_by_nothing(spark, tmp_path):
    from shelfmark.sources import layers

    df = spark.createDataFrame([(1,), (2,)], "v int")
    for part in (df, df.limit(0)):
        path = layers.append_layer(part, str(tmp_path), "bronze", "things", "b1", replace_batch=True)
        gold = layers.write_gold(part, str(tmp_path), "facts", "b1")
    layers.append_layer(df, str(tmp_path), "bronze", "things", "b2", replace_batch=True)
    assert spark.read.parquet(path).select("batch_id").distinct().collect()[0][0] == "b2"
    assert not layers.child_folders(spark, gold)
