import pytest
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.operators import catalog as ct
from opinlake.operators import quality
from opinlake.sources.catalog import list_products

REVIEW = {"product_id": " P1 ", "user_id": "U1", "score": 3, "text": "\n ok ", "source": "app"}


def reviews(spark, *changes):
    rows = [tuple({**REVIEW, **change}.values()) for change in changes]
    return spark.createDataFrame(
        rows, "product_id string, user_id string, score int, text string, source string"
    )


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"source": None}, None),
        ({"product_id": " "}, "Product id is required"),
        ({"product_id": None}, "Product id is required"),
        ({"product_id": "p" * 101}, "Product id is too long"),
        ({"product_id": " " + "p" * 100 + "\n"}, None),
        ({"user_id": ""}, "User id is required"),
        ({"user_id": "u" * 101}, "User id is too long"),
        ({"score": 0}, "Review score must be between 1 and 5"),
        ({"score": 6}, "Review score must be between 1 and 5"),
        ({"score": None}, "Review score must be between 1 and 5"),
        ({"text": " \t"}, "Review text is required"),
        ({"text": "t" * 2001}, "Review text is too long"),
        ({"text": "t" * 2000}, None),
        ({"source": "  "}, "Review source is required"),
        ({"source": "s" * 51}, "Review source is too long"),
        ({"product_id": "", "score": 9}, "Product id is required"),
        ({"score": 9, "text": ""}, "Review score must be between 1 and 5"),
    ],
)
def test_first_broken_rule_is_named(spark, change, reason):
    assert quality.check_reviews(reviews(spark, change)).first().rejection == reason


def test_accepted_reviews_are_stripped_and_nothing_is_lost(spark, tmp_path):
    checked = quality.check_reviews(reviews(spark, {}, {"score": 7}, {"source": None}))
    good = quality.accepted(checked).collect()
    assert [(r.product_id, r.text) for r in good] == [("P1", "ok")] * 2
    assert sorted(r.source for r in good) == ["app", "web"]
    assert quality.quarantined(checked).count() == 1
    assert [tuple(r) for r in quality.rejection_counts(checked).collect()] == [
        ("Review score must be between 1 and 5", 1)
    ]
    quality.write_split(checked, str(tmp_path / "split"))
    lanes = spark.read.parquet(str(tmp_path / "split")).groupBy("lane").count().collect()
    assert {r["lane"]: r["count"] for r in lanes} == {"accepted": 2, "quarantined": 1}


PRODUCTS = [
    ("P001", "Green Tea", "Tea", "Light", "http://x", 12.5, ["organic", "loose leaf"]),
    ("P002", "Coffee", "Coffee", "Dark tea-free roast", "http://x", 18.0, []),
    ("P003", "Honey", "Pantry", "Mellow", "http://x", 9.0, ["for Tea"]),
]


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, schemas.CATALOG)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"product_id": " "}, "Product id is required"),
        ({"name": ""}, "Product name is required"),
        ({"category": None}, "Product category is required"),
        ({"price": -0.01}, "Product price cannot be negative"),
        ({"image_url": "\n"}, "Product image URL is required"),
        ({"price": 0.0}, None),
    ],
)
def test_product_rules(spark, change, reason):
    names = schemas.CATALOG.fieldNames()
    row = {**dict(zip(names, PRODUCTS[0], strict=True)), **change}
    frame = spark.createDataFrame([tuple(row.values())], schemas.CATALOG)
    assert quality.check_products(frame).first().rejection == reason


def test_repeated_products_are_found(spark):
    twice = spark.createDataFrame([*PRODUCTS, PRODUCTS[1]], schemas.CATALOG)
    assert [tuple(r) for r in quality.repeated_products(twice).collect()] == [("P002", 2)]


def test_blank_tags_are_dropped(spark):
    row = (*PRODUCTS[0][:6], [" a ", "", "\t", "b"])
    checked = quality.check_products(spark.createDataFrame([row], schemas.CATALOG))
    assert checked.first().tags == ["a", "b"]


def test_lookup_ignores_case_and_blanks(products):
    assert [r.name for r in ct.find_product(products, " p002\n").collect()] == ["Coffee"]
    assert ct.find_product(products, "P9").count() == 0


@pytest.mark.parametrize(
    ("term", "category", "found"),
    [
        ("", "All", ["P001", "P002", "P003"]),
        (" TEA ", "All", ["P001", "P002", "P003"]),
        ("tea", "Tea", ["P001"]),
        ("leaf", "All", ["P001"]),
        ("", "Pantry", ["P003"]),
        ("a.b", "All", []),
    ],
)
def test_search(products, term, category, found):
    rows = ct.search(products, term, category).orderBy("product_id").collect()
    assert [r.product_id for r in rows] == found


def test_categories_and_list(products):
    assert [r.category for r in ct.categories(products).collect()] == ["Coffee", "Pantry", "Tea"]
    assert [r.product_id for r in list_products(products).collect()] == ["P001", "P002", "P003"]


@pytest.fixture(scope="module")
def reviewed(spark):
    ids = ["P001", " p001 ", "P9", None, " p003"]
    return spark.createDataFrame([(n, v) for n, v in enumerate(ids)], "n int, product_id string")


NAMES = ["Green Tea", "Green Tea", None, None, "Honey"]


@pytest.mark.parametrize("limit", [ct.BROADCAST_LIMIT_BYTES, 0])
def test_enrichment_is_the_same_with_and_without_broadcast(spark, products, reviewed, limit):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, -1)
        rows = ct.enrich_with_catalog(reviewed, products, limit)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) is (limit > 0)
        assert [r.product_name for r in rows.orderBy("n").collect()] == NAMES
    finally:
        spark.conf.set(threshold, before)


def test_known_and_unknown_products_are_complements(products, reviewed):
    known = quality.known_products(reviewed, products)
    unknown = quality.unknown_products(reviewed, products)
    assert sorted(r.n for r in known.collect()) == [0, 1, 4]
    assert sorted(r.n for r in unknown.collect()) == [2, 3]
    assert known.columns == reviewed.columns


def test_labels(products, reviewed):
    rows = ct.with_label(ct.with_product_name(reviewed, products)).orderBy("n").collect()
    assert [r.product_label for r in rows] == [
        "Green Tea", "Green Tea", "P9", "Unknown product", "Honey",
    ]


def test_case_variants_stay_two_rows_with_one_name(spark, products, make_silver):
    from opinlake.operators import reports as rp

    silver = make_silver([{"product_id": p, "score": 4, "text": "x"} for p in ("p001", "P001")])
    rows = rp.product_scores(silver, catalog=products).collect()
    assert [(r.product_id, r.product_name) for r in rows] == [
        ("P001", "Green Tea"),
        ("p001", "Green Tea"),
    ]


def test_measured_size_counts_all_columns(spark):
    wide, empty = F.lit("x" * 100).alias("a"), F.lit(None).cast("string").alias("b")
    frame = spark.range(10).select(wide, empty)
    hinted = ct.sized_for_broadcast(frame, 10 * (100 + 32))
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert ct.sized_for_broadcast(frame, 10 * (100 + 32) - 1) is frame
