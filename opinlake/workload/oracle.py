"""The SQL counterpart of each query, for DuckDB over the same tables.

Written against the rules, not against the Spark code: word counts count separators, keyword
flags consume the neighbouring characters, the dashboard is eleven plain queries.
"""

from __future__ import annotations

from opinlake.functions.text import WIDE_SPACE, WORD_CHARS
from opinlake.workload import tables as tb

SPACE = r"[ \t\n\x0B\f\r]"
WIDE = f"[{WIDE_SPACE}]"
NEGATIVE = "bad|terrible|awful|disappointed|stale|broken|poor|worst|expired|disgusting"
POSITIVE = "great|excellent|amazing|good|perfect|love|tasty|fresh|recommend"


def _flag(words: str, text: str = "text") -> str:
    edge = f"[^{WORD_CHARS}]"
    return f"regexp_matches(lower(coalesce({text}, '')), '(^|{edge})(?:{words})($|{edge})')"


def _stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{WIDE}+|{WIDE}+$', '', 'g')"


TEXT_LENGTH = "CAST(length(coalesce(text, '')) AS INTEGER)"
WORD_COUNT = (
    "CAST(CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 0"
    f" ELSE 1 + len(regexp_extract_all(trim(text), '{SPACE}+')) END AS INTEGER)"
)
WORD_COUNT_STRICT = (
    f"CAST(len(regexp_extract_all(coalesce(text, ''), '[^{WIDE_SPACE}]+')) AS INTEGER)"
)
SENTIMENT = (
    "CASE WHEN score IN (4, 5) THEN 'positive' WHEN score = 3 THEN 'neutral' ELSE 'negative' END"
)


def _enriched(words: str = WORD_COUNT) -> str:
    return (
        f"{SENTIMENT} AS sentiment, {TEXT_LENGTH} AS text_length, {words} AS word_count,"
        f" {_flag(NEGATIVE)} AS has_negative_keywords,"
        f" {_flag(POSITIVE)} AS has_positive_keywords"
    )


HISTORY_COLUMNS = (
    "Id, ProductId, UserId, ProfileName, HelpfulnessNumerator, HelpfulnessDenominator,"
    " Score, Time, Summary, Text"
)
REQUIRED = " AND ".join(
    f"{c} IS NOT NULL" for c in ("Id", "ProductId", "UserId", "Score", "Text", "Time")
)
NONBLANK = " AND ".join(f"length(trim({c})) > 0" for c in ("ProductId", "UserId", "Text"))
INTEGER = "'[+-]?[0-9]+(\\.0+)?'"
SECONDS = f"CASE WHEN regexp_full_match(Time, {INTEGER}) THEN CAST(split_part(Time, '.', 1) AS HUGEINT) END"
IN_RANGE = (
    f"regexp_full_match(Id, {INTEGER}) AND {SECONDS} BETWEEN -62135596800 AND 253402300799"
    f" AND regexp_full_match(Score, {INTEGER})"
    " AND TRY_CAST(split_part(Score, '.', 1) AS INTEGER) BETWEEN 1 AND 5"
)
REJECTS = " ".join(
    f"WHEN {test} THEN '{words}'"
    for test, words in (
        *((f"{c} IS NULL", f"{c} is missing") for c in "Id ProductId UserId Score Text Time".split()),
        *((f"length(trim({c})) = 0", f"{c} is blank") for c in "ProductId UserId Text".split()),
        (f"NOT regexp_full_match(Score, {INTEGER})", "Score is no whole number"),
        (
            "CAST(split_part(Score, '.', 1) AS INTEGER) NOT BETWEEN 1 AND 5",
            "Score is out of range",
        ),
        (f"NOT regexp_full_match(Id, {INTEGER})", "Id is no whole number"),
        (f"NOT regexp_full_match(Time, {INTEGER})", "Time is no whole number"),
        (
            f"NOT ({SECONDS} BETWEEN -62135596800 AND 253402300799)",
            "Time is outside the years 1 to 9999",
        ),
    )
)

ISO = (
    "CASE WHEN epoch_us(created_at) % 1000000 = 0"
    " THEN strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00')"
    " ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
)
JSON = (
    "CAST(json_object('product_id', product_id, 'user_id', user_id, 'score', score, 'text', text,"
    f" 'source', source, 'review_id', review_id, 'created_at', {ISO}) AS VARCHAR)"
)

_SILVER_COLUMNS = (
    "kafka_key, topic, partition, \"offset\", kafka_timestamp, product_id, user_id, score, text,"
    " source, review_id, created_at, sentiment, text_length, word_count, has_negative_keywords,"
    " has_positive_keywords"
)

# Offsets (modulo 100) of records without any field, and rows that a quarantine keeps out.
NO_EVENT = "0, 7, 13, 19, 23, 33"
QUARANTINED = (
    f"(\"offset\" % 100 IN ({NO_EVENT}, 51, 67, 77) OR \"offset\" % 29 = 0"
    " OR product_id IS NULL OR user_id IS NULL OR text IS NULL)"
)

_VIEWS = {
    "history": tb.duckdb_text(tb.HISTORY),
    "cleaned": f"SELECT * FROM history WHERE {REQUIRED} AND {NONBLANK} AND {IN_RANGE}",
    "batch_reviews": (
        "SELECT CAST(NULL AS VARCHAR) AS kafka_key, CAST(NULL AS VARCHAR) AS topic,"
        " CAST(NULL AS INTEGER) AS partition, CAST(NULL AS BIGINT) AS \"offset\","
        " CAST(NULL AS TIMESTAMP) AS kafka_timestamp, ProductId AS product_id,"
        " UserId AS user_id, CAST(split_part(Score, '.', 1) AS INTEGER) AS score, Text AS text,"
        " 'amazon_csv' AS source, split_part(Id, '.', 1) AS review_id,"
        " make_timestamp(CAST(split_part(Time, '.', 1) AS BIGINT) * 1000000) AS created_at"
        " FROM cleaned"
    ),
    "live": tb.duckdb_text(tb.LIVE),
    "records": (
        "SELECT nullif(product_id, '') AS kafka_key,"
        " CASE event_id % 100 WHEN 0 THEN 'garbage' WHEN 33 THEN NULL WHEN 7 THEN ''"
        " WHEN 13 THEN '  ' WHEN 19 THEN '{}' WHEN 23 THEN 'null'"
        " WHEN 51 THEN regexp_replace(json, '\"score\":([0-9])', '\"score\":\"\\1\"')"
        " WHEN 67 THEN regexp_replace(json, '\"score\":([0-9])', '\"score\":\\1.5')"
        " WHEN 77 THEN regexp_replace(json, '\"score\":[0-9],', '')"
        " WHEN 83 THEN"
        "  regexp_replace(json, '\"created_at\":\"[^\"]*\"', '\"created_at\":\"soon\"')"
        " ELSE json END AS json_value, 'reviews' AS topic,"
        " CAST(event_id % 3 AS INTEGER) AS partition, event_id AS \"offset\","
        f" ts AS kafka_timestamp FROM (SELECT *, {JSON} AS json FROM live)"
    ),
    "stream_reviews": (
        "SELECT nullif(product_id, '') AS kafka_key, 'reviews' AS topic,"
        " CAST(event_id % 3 AS INTEGER) AS partition, event_id AS \"offset\","
        " ts AS kafka_timestamp,"
        + ", ".join(
            f" CASE WHEN event_id % 100 IN ({dropped}) THEN NULL ELSE {c} END AS {c}"
            for c, dropped in (
                ("product_id", NO_EVENT),
                ("user_id", NO_EVENT),
                ("score", f"{NO_EVENT}, 51, 67, 77"),
                ("text", NO_EVENT),
                ("source", NO_EVENT),
                ("review_id", NO_EVENT),
                ("created_at", f"{NO_EVENT}, 83"),
            )
        )
        + " FROM live"
    ),
    "batch_silver": f"SELECT *, {_enriched()} FROM batch_reviews",
    "stream_silver": f"SELECT *, {_enriched()} FROM stream_reviews",
    "silver": "SELECT * FROM batch_silver UNION ALL BY NAME SELECT * FROM stream_silver",
    "counted": (
        "SELECT * FROM silver WHERE product_id IS NULL OR upper(product_id) NOT LIKE 'E2E%'"
    ),
    "catalog": tb.duckdb_text(tb.CATALOG),
    "raw_catalog": tb.duckdb_text(tb.RAW_CATALOG),
    "submissions": tb.duckdb_text(tb.SUBMISSIONS),
    "texts": tb.duckdb_text(tb.TEXTS),
    "checked": (
        "SELECT *, CASE"
        " WHEN coalesce(product_id, '') = '' THEN 'Product id is required'"
        " WHEN length(product_id) > 100 THEN 'Product id is too long'"
        " WHEN coalesce(user_id, '') = '' THEN 'User id is required'"
        " WHEN length(user_id) > 100 THEN 'User id is too long'"
        " WHEN score IS NULL OR score < 1 OR score > 5"
        "  THEN 'Review score must be between 1 and 5'"
        " WHEN coalesce(text, '') = '' THEN 'Review text is required'"
        " WHEN length(text) > 2000 THEN 'Review text is too long'"
        " WHEN source = '' THEN 'Review source is required'"
        " WHEN length(source) > 50 THEN 'Review source is too long' END AS rejection"
        f" FROM (SELECT id, {_stripped('product_id')} AS product_id,"
        f" {_stripped('user_id')} AS user_id, score, {_stripped('text')} AS text,"
        f" {_stripped("coalesce(source, 'web')")} AS source, ts FROM submissions)"
    ),
    "sample": (
        "SELECT ProductId AS product_id, UserId AS user_id, CAST(Score AS INTEGER) AS score,"
        " Text AS text, 'sample_csv' AS source, Id AS review_id,"
        " make_timestamp(CAST(Time AS BIGINT) * 1000000) AS created_at FROM typed"
    ),
    "typed": (
        "SELECT * REPLACE (split_part(Score, '.', 1) AS Score, split_part(Time, '.', 1) AS Time)"
        " FROM cleaned"
    ),
    "sample_reviews": f"SELECT *, {_enriched(WORD_COUNT_STRICT)} FROM sample",
}

_NEEDS = {
    "cleaned": ["history"],
    "batch_reviews": ["cleaned"],
    "records": ["live"],
    "stream_reviews": ["live"],
    "batch_silver": ["batch_reviews"],
    "stream_silver": ["stream_reviews"],
    "silver": ["batch_silver", "stream_silver"],
    "counted": ["silver"],
    "checked": ["submissions"],
    "typed": ["cleaned"],
    "sample": ["typed"],
    "sample_reviews": ["sample"],
}


def _with(views: str, body: str) -> str:
    """`body` preceded by the views it reads and those behind them."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({_VIEWS[name]})" for name in order)
    return f"WITH {ctes}\n{body}"


OPINION_COLUMNS = (
    "product_id, user_id, score, sentiment, text, source, review_id, created_at, text_length,"
    " word_count, has_negative_keywords, has_positive_keywords"
)
OPINION_TIES = (
    "created_at DESC NULLS LAST, review_id NULLS FIRST, product_id NULLS FIRST,"
    " user_id NULLS FIRST, score NULLS FIRST, source NULLS FIRST, text NULLS FIRST"
)
HAS_TEXT = "text IS NOT NULL AND length(trim(text)) > 0"
VISIBLE = f"text IS NOT NULL AND regexp_matches(text, '[^{WIDE_SPACE}]')"


def _key(column: str = "product_id") -> str:
    return f"upper({_stripped(column)})"


def _named(rows: str) -> str:
    return (
        f"SELECT r.*, c.name AS product_name FROM ({rows}) AS r LEFT JOIN catalog AS c"
        f" ON {_key('r.product_id')} = c.product_id"
    )


def _newest(rows: str, where: str, limit: int) -> str:
    return (
        f"SELECT {OPINION_COLUMNS} FROM {rows} WHERE {where}"
        f" ORDER BY {OPINION_TIES} LIMIT {limit}"
    )


def _opinions(limit: int, extra: str = "", text: str = HAS_TEXT) -> str:
    where = f"created_at IS NOT NULL AND {text}{extra}"
    return _newest("counted", where, limit)


NEGATIVES = "CAST(sum(CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END) AS BIGINT)"
_STATS = "product_id, count(*) AS review_count, avg(score) AS average_score"


def _ranking(rows: str, order: str, least: int, limit: int = 10) -> str:
    return (
        f"SELECT {_STATS} FROM {rows} GROUP BY product_id HAVING count(*) >= {least}"
        f" ORDER BY {order}, product_id NULLS FIRST LIMIT {limit}"
    )


BEST = "average_score DESC NULLS LAST, review_count DESC"
WORST = "average_score ASC NULLS FIRST, review_count DESC"
MOST = "review_count DESC, average_score DESC NULLS LAST"


def _disliked(rows: str, least: int, limit: int = 10) -> str:
    return (
        f"SELECT {NEGATIVES} AS negative_review_count, {_STATS} FROM {rows} GROUP BY product_id"
        f" HAVING count(*) >= {least} AND {NEGATIVES} > 0"
        " ORDER BY negative_review_count DESC, average_score ASC NULLS FIRST,"
        f" product_id NULLS FIRST LIMIT {limit}"
    )


def _counts(rows: str, label: str) -> str:
    return f"SELECT {label}, count(*) AS review_count FROM {rows} GROUP BY {label}"


_SOURCES = (
    "SELECT coalesce(source, 'unknown') AS source, count(*) AS review_count FROM counted"
    " GROUP BY coalesce(source, 'unknown')"
)
_SUMMARY = (
    "SELECT count(*) AS total_reviews, avg(score) AS average_score,"
    " min(created_at) AS first_review_at, max(created_at) AS last_review_at FROM "
)


def _keywords(kind: str, rows: str = "counted", text: str = f" AND {HAS_TEXT}") -> str:
    return (
        f"SELECT '{kind}' AS keyword_type, count(*) AS matching_reviews FROM {rows}"
        f" WHERE has_{kind}_keywords{text}"
    )


_BUNDLE = {
    "review_id": "VARCHAR",
    "product_name": "VARCHAR",
    "text": "VARCHAR",
    "created_at": "TIMESTAMP",
    "first_review_at": "TIMESTAMP",
    "last_review_at": "TIMESTAMP",
    "review_count": "BIGINT",
    "negative_review_count": "BIGINT",
    "average_score": "DOUBLE",
}


def _part(report: str, rows: str, label: str | None, **columns: str) -> str:
    shown = ", ".join(
        f"CAST({columns.get(name, 'NULL')} AS {kind}) AS {name}" for name, kind in _BUNDLE.items()
    )
    return (
        f"SELECT '{report}' AS report, CAST({label or 'NULL'} AS VARCHAR) AS label, {shown}"
        f" FROM ({rows})"
    )


def _bundle(rows: str, text: str, opinion_text: str, source: str, least: int) -> list[str]:
    dated = "created_at IS NOT NULL AND " if rows == "counted" else ""
    newest = _named(_newest(rows, f"{dated}{opinion_text}", 20))
    ranked = {
        "review_count": "review_count",
        "average_score": "average_score",
        "product_name": "product_name",
    }
    opinion = {
        "review_id": "review_id",
        "product_name": "product_name",
        "text": "text",
        "created_at": "created_at",
    }
    count = {"review_count": "review_count"}
    return [
        _summary_part(rows),
        _part("sentiment", _counts(rows, "sentiment"), "sentiment", **count),
        _part("score_distribution", _counts(rows, "score"), "score", **count),
        _part("top_products", _named(_ranking(rows, BEST, least)), "product_id", **ranked),
        _part("worst_products", _named(_ranking(rows, WORST, least)), "product_id", **ranked),
        _part(
            "negative_products",
            _named(_disliked(rows, least)),
            "product_id",
            negative_review_count="negative_review_count",
            **ranked,
        ),
        _part("recent_reviews", newest, "product_id", score="score", **opinion),
        _part("sources", source, "source", **count),
        _part("opinions", newest, "product_id", **opinion),
        *(
            _part(
                f"{kind}_keywords",
                _keywords(kind, rows, text),
                "keyword_type",
                review_count="matching_reviews",
            )
            for kind in ("negative", "positive")
        ),
    ]


def _summary_part(rows: str) -> str:
    return _part(
        "summary",
        _SUMMARY + rows,
        None,
        review_count="total_reviews",
        average_score="coalesce(average_score, 0.0)",
        first_review_at="first_review_at",
        last_review_at="last_review_at",
    )


_DASHBOARD = _bundle("counted", f" AND {HAS_TEXT}", VISIBLE, _SOURCES, 1)
_DASHBOARD_SQL = "\nUNION ALL ".join(_DASHBOARD)
_SAMPLE_SQL = "\nUNION ALL ".join(
    _bundle("sample_reviews", "", "true", _counts("sample_reviews", "source"), 1)
)


def _cube_level(level: str, column: str | None) -> str:
    kinds = {
        "sentiment": "VARCHAR",
        "score": "INTEGER",
        "source": "VARCHAR",
        "product_id": "VARCHAR",
    }
    value = "coalesce(source, 'unknown')" if column == "source" else column
    shown = ", ".join(
        f"{value if name == column else f'CAST(NULL AS {kind})'} AS {name}"
        for name, kind in kinds.items()
    )
    group = f" GROUP BY {value}" if column else ""
    flags = ", ".join(
        f"count(*) FILTER (has_{kind}_keywords AND {HAS_TEXT}) AS {kind}_keyword_reviews"
        for kind in ("negative", "positive")
    )
    return (
        f"SELECT '{level}' AS level, {shown}, count(*) AS review_count,"
        f" avg(score) AS average_score, {NEGATIVES} AS negative_review_count,"
        " min(created_at) AS first_review_at, max(created_at) AS last_review_at,"
        f" {flags} FROM counted{group}"
    )


_CUBE = "\nUNION ALL ".join(
    _cube_level(level, column)
    for level, column in (
        ("all", None),
        ("sentiment", "sentiment"),
        ("score", "score"),
        ("source", "source"),
        ("product", "product_id"),
    )
)


_DENSE = (
    "SELECT CAST(s AS INTEGER) AS score, count(c.product_id_or_blank) AS review_count"
    " FROM range(1, 6) AS r(s) LEFT JOIN"
    " (SELECT score, coalesce(product_id, '') AS product_id_or_blank FROM counted) AS c"
    " ON c.score = s GROUP BY s"
)


def _scaled(kind: str, report: str) -> str:
    return (
        f"SELECT '{kind}' AS kind, label, review_count,"
        " CAST(greatest(6, floor(CAST(review_count AS DOUBLE) / max(review_count) OVER () * 100"
        " + 0.5)) AS INTEGER) AS percent FROM"
        f" (SELECT CAST({kind} AS VARCHAR) AS label, review_count FROM ({report}))"
    )


_SILVER_TYPES = (
    ("kafka_key", "string"), ("topic", "string"), ("partition", "int"), ("offset", "bigint"),
    ("kafka_timestamp", "timestamp"), ("product_id", "string"), ("user_id", "string"),
    ("score", "int"), ("text", "string"), ("source", "string"), ("review_id", "string"),
    ("created_at", "timestamp"), ("sentiment", "string"), ("text_length", "int"),
    ("word_count", "int"), ("has_negative_keywords", "boolean"),
    ("has_positive_keywords", "boolean"),
)
_DESCRIBED = ", ".join(f"('{name}', '{kind}')" for name, kind in _SILVER_TYPES)

_CATALOG_COLUMNS = (
    "product_id, name, category, description, image_url, price,"
    " array_to_string(tags, '|') AS tags"
)
_SEARCH_TEXT = (
    "lower(name || ' ' || category || ' ' || description || ' ' || array_to_string(tags, ' '))"
)
_CHECKED_PRODUCTS = (
    f"SELECT p_partkey, {_stripped('product_id')} AS product_id, {_stripped('name')} AS name,"
    f" {_stripped('category')} AS category, {_stripped('description')} AS description,"
    f" {_stripped('image_url')} AS image_url, price,"
    f" array_to_string(list_filter(list_transform(tags, lambda t: {_stripped('t')}),"
    " lambda t: t <> ''), '|') AS tags FROM raw_catalog"
)
_LISTED = f"{_key()} IN (SELECT product_id FROM catalog)"
_COMPLETE = ", ".join(
    f"('{name}')"
    for name in (
        "summary", "sentiment", "score_distribution", "top_products", "worst_products",
        "negative_products", "recent_reviews", "sources", "opinions", "negative_keywords",
        "positive_keywords",
    )
)

_REVIEW_COLUMNS = "product_id, user_id, score, text, source, review_id, created_at"
_ORIGIN = "kafka_key, topic, partition, \"offset\", kafka_timestamp"
_STREAM_SILVER = _with("stream_silver", f"SELECT {_SILVER_COLUMNS} FROM stream_silver")
_BATCH_SILVER = _with("batch_silver", f"SELECT {_SILVER_COLUMNS} FROM batch_silver")
_BOTH_SILVER = _with("silver", f"SELECT {_SILVER_COLUMNS} FROM silver")
_PARSED = _with("stream_reviews", f"SELECT {_ORIGIN}, {_REVIEW_COLUMNS} FROM stream_reviews")
_BRONZE = _with("records", f"SELECT kafka_key, json_value, {_ORIGIN[11:]} FROM records")
_HISTORY = _with("history", f"SELECT {HISTORY_COLUMNS} FROM history")


def _history_where(condition: str) -> str:
    return _with("history", f"SELECT {HISTORY_COLUMNS} FROM history WHERE {condition}")


def _counted(body: str) -> str:
    return _with("counted", body)


def _counted_named(body: str) -> str:
    return _with("counted catalog", _named(body))


_AUDIT = (
    "SELECT (SELECT count(*) FROM history) AS raw_rows,"
    " (SELECT count(*) FROM cleaned) AS cleaned_rows,"
    " (SELECT count(*) FROM cleaned) AS written_rows"
)

ORACLE: dict[str, str] = {
    # sources
    "csv_scan": _HISTORY,
    "csv_scan_split": _HISTORY,
    "sample_scan": _with("sample_reviews", f"SELECT {OPINION_COLUMNS} FROM sample_reviews"),
    "silver_scan": _BOTH_SILVER,
    "external_table": _BOTH_SILVER,
    "silver_union": _BOTH_SILVER,
    "table_peek": _with(
        "silver",
        "SELECT col_name, data_type, (SELECT count(*) FROM silver) AS row_count"
        f" FROM (VALUES {_DESCRIBED}) AS d(col_name, data_type)",
    ),
    "catalog_list": _with("catalog", f"SELECT {_CATALOG_COLUMNS} FROM catalog"),
    "topic_peek": _with(
        "records",
        "SELECT kafka_key, json_value, partition, \"offset\" FROM records"
        " ORDER BY \"offset\", partition LIMIT 5",
    ),
    "silver_preview": _with(
        "silver",
        "SELECT product_id, user_id, score, sentiment, source, text_length, word_count,"
        " has_negative_keywords, has_positive_keywords, text, review_id, created_at, \"offset\""
        " FROM silver ORDER BY \"offset\" DESC NULLS LAST, review_id NULLS FIRST LIMIT 20",
    ),
    # cleaning and ingest
    "clean_required": _history_where(REQUIRED),
    "clean_nonblank": _history_where(NONBLANK),
    "clean_ranges": _history_where(IN_RANGE),
    "clean_reviews": _with("cleaned", f"SELECT {HISTORY_COLUMNS} FROM cleaned"),
    "normalize_reviews": _BATCH_SILVER,
    "batch_ingest": _BATCH_SILVER,
    "ingest_audit": _with("cleaned", _AUDIT),
    "load_audits": _with("cleaned", _AUDIT),
    "bronze_json_roundtrip": _with("cleaned", f"SELECT {HISTORY_COLUMNS} FROM cleaned"),
    "batch_dedup": _with(
        "silver",
        f"SELECT {_SILVER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY review_id,"
        " source ORDER BY created_at IS NULL, kafka_timestamp IS NULL, \"offset\" IS NULL,"
        " created_at, kafka_timestamp, \"offset\", kafka_key NULLS FIRST, topic NULLS FIRST,"
        " partition NULLS FIRST, product_id NULLS FIRST, user_id NULLS FIRST,"
        " score NULLS FIRST, text NULLS FIRST) AS place FROM silver WHERE review_id IS NOT NULL)"
        f" WHERE place = 1 UNION ALL SELECT {_SILVER_COLUMNS} FROM silver"
        f" WHERE review_id IS NULL UNION ALL SELECT {_SILVER_COLUMNS} FROM silver"
        " WHERE review_id IS NULL",
    ),
    "history_rejects": _with(
        "history",
        f"SELECT reason, count(*) AS rejected FROM (SELECT CASE {REJECTS} END AS reason"
        " FROM history) WHERE reason IS NOT NULL GROUP BY reason",
    ),
    # events
    "kafka_envelope": _BRONZE,
    "json_parse": _PARSED,
    "json_quarantine": _with(
        "records stream_reviews",
        f"SELECT kafka_key, json_value, {_ORIGIN[11:]} FROM records WHERE \"offset\" IN"
        f" (SELECT \"offset\" FROM stream_reviews WHERE {QUARANTINED})",
    ),
    "json_accepted": _with(
        "stream_reviews",
        f"SELECT {_ORIGIN}, {_REVIEW_COLUMNS} FROM stream_reviews WHERE NOT {QUARANTINED}",
    ),
    "bronze_peek": _with(
        "records",
        f"SELECT kafka_key, json_value, {_ORIGIN[11:]} FROM records"
        " ORDER BY \"offset\", partition LIMIT 5",
    ),
    "table_first_rows": _with(
        "silver",
        f"SELECT {_SILVER_COLUMNS} FROM silver ORDER BY review_id NULLS LAST,"
        " source NULLS LAST, created_at NULLS LAST, \"offset\" NULLS LAST LIMIT 10",
    ),
    "plain_values": _with(
        "silver",
        "SELECT review_id, source, "
        + ", ".join(
            f"CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S')"
            f" ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END AS {c}"
            for c in ("created_at", "kafka_timestamp")
        )
        + " FROM silver",
    ),
    "kafka_encode": _with(
        "live", f"SELECT nullif(product_id, '') AS key, {JSON} AS value FROM live"
    ),
    "json_roundtrip": _with("live", f"SELECT {_REVIEW_COLUMNS} FROM live"),
    "event_defaults": _with(
        "submissions",
        "SELECT id, coalesce(user_id, 'web-client') AS user_id, coalesce(source, 'web') AS source,"
        " substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||"
        " substr(h, 17, 4) || '-' || substr(h, 21, 12) AS review_id, ts AS created_at"
        " FROM (SELECT *, md5('{\"c0\":\"' || id || '\"}') AS h FROM submissions)",
    ),
    "enrich_reviews": _STREAM_SILVER,
    # text and rules
    "text_length": _with("texts", f"SELECT id, {TEXT_LENGTH} AS text_length FROM texts"),
    "word_count": _with("texts", f"SELECT id, {WORD_COUNT} AS word_count FROM texts"),
    "word_count_strict": _with(
        "texts", f"SELECT id, {WORD_COUNT_STRICT} AS word_count FROM texts"
    ),
    "keyword_flags": _with(
        "texts",
        f"SELECT id, {_flag(NEGATIVE)} AS has_negative_keywords,"
        f" {_flag(POSITIVE)} AS has_positive_keywords FROM texts",
    ),
    "sentiment_rule": _with(
        "stream_reviews", f"SELECT \"offset\", score, {SENTIMENT} AS sentiment FROM stream_reviews"
    ),
    "row_filter": _counted("SELECT review_id, product_id, source FROM counted"),
    "text_filter": _with(
        "silver", f"SELECT review_id, product_id, source FROM silver WHERE {HAS_TEXT}"
    ),
    # quality
    "validate_reviews": _with(
        "checked",
        "SELECT id, product_id, user_id, score, text, source, ts FROM checked"
        " WHERE rejection IS NULL",
    ),
    "quarantine_reasons": _with(
        "checked",
        "SELECT rejection AS reason, count(*) AS rejected FROM checked"
        " WHERE rejection IS NOT NULL GROUP BY rejection",
    ),
    "catalog_validate": _with(
        "raw_catalog",
        "SELECT *, CASE WHEN product_id = '' THEN 'Product id is required'"
        " WHEN name = '' THEN 'Product name is required'"
        " WHEN coalesce(category, '') = '' THEN 'Product category is required'"
        " WHEN price < 0 THEN 'Product price cannot be negative'"
        " WHEN image_url = '' THEN 'Product image URL is required' END AS rejection"
        f" FROM ({_CHECKED_PRODUCTS})",
    ),
    "known_products": _with(
        "silver catalog", f"SELECT review_id, product_id, source FROM silver WHERE {_LISTED}"
    ),
    "unknown_products": _with(
        "silver catalog",
        f"SELECT review_id, product_id, source FROM silver WHERE ({_LISTED}) IS NOT TRUE",
    ),
    # catalog
    "catalog_lookup": _with(
        "catalog", f"SELECT {_CATALOG_COLUMNS} FROM catalog WHERE product_id = 'P17'"
    ),
    "catalog_search": _with(
        "catalog",
        f"SELECT {_CATALOG_COLUMNS}, 'narrow' AS search FROM catalog"
        f" WHERE category = 'ECONOMY' AND contains({_SEARCH_TEXT}, 'red') UNION ALL"
        f" SELECT {_CATALOG_COLUMNS}, 'wide' FROM catalog"
        f" WHERE contains({_SEARCH_TEXT}, 'brand#2')",
    ),
    "catalog_categories": _with("catalog", "SELECT DISTINCT category FROM catalog"),
    "enrich_catalog": _with(
        "silver catalog", _named("SELECT review_id, product_id, source, score FROM silver")
    ),
    "product_label": _with(
        "silver catalog",
        "SELECT *, CASE WHEN product_name <> '' THEN product_name WHEN product_id <> ''"
        " THEN product_id ELSE 'Unknown product' END AS product_label FROM ("
        + _named(f"SELECT {_STATS} FROM silver GROUP BY product_id")
        + ")",
    ),
    # reports
    "summary": _counted(_SUMMARY + "counted"),
    "summary_defaults": _counted(_SUMMARY + "counted"),
    "sentiment_counts": _counted(_counts("counted", "sentiment")),
    "score_distribution": _counted(_counts("counted", "score")),
    "score_distribution_dense": _counted(_DENSE),
    "sources": _counted(_SOURCES),
    "negative_keywords": _counted(_keywords("negative")),
    "positive_keywords": _counted(_keywords("positive")),
    "product_scores": _counted_named(_ranking("counted", MOST, 1)),
    "top_products": _counted_named(_ranking("counted", BEST, 30)),
    "worst_products": _counted_named(_ranking("counted", WORST, 30)),
    "negative_products": _counted_named(_disliked("counted", 30)),
    "recent_reviews": _counted_named(_opinions(20)),
    "opinions": _counted_named(_opinions(50)),
    "opinions_positive": _counted_named(_opinions(50, " AND sentiment = 'positive'")),
    "opinions_neutral": _counted_named(_opinions(50, " AND sentiment = 'neutral'")),
    "opinions_negative": _counted_named(_opinions(50, " AND sentiment = 'negative'")),
    "dashboard_recent": _counted_named(_opinions(20, text=VISIBLE)),
    "raw_total": _with("silver", "SELECT count(*) AS total_reviews FROM silver"),
    "raw_sentiment": _with("silver", _counts("silver", "sentiment")),
    "raw_scores": _with("silver", _counts("silver", "score")),
    "raw_sources": _with("silver", _counts("silver", "source")),
    "raw_top": _with("silver", _ranking("silver", BEST, 5)),
    "raw_worst": _with("silver", _ranking("silver", WORST, 5)),
    "raw_negative": _with("silver", _disliked("silver", 3)),
    "raw_product_scores": _with("silver", f"SELECT {_STATS} FROM silver GROUP BY product_id"),
    "dashboard_cube": _counted(_CUBE),
    "scaled_counts": _counted(
        " UNION ALL ".join(
            _scaled(kind, report)
            for kind, report in (
                ("sentiment", _counts("counted", "sentiment")),
                ("score", _DENSE),
                ("source", _SOURCES),
            )
        )
    ),
    # bundles
    "dashboard": _with("counted catalog", _DASHBOARD_SQL),
    "dashboard_by_report": _with("counted catalog", _DASHBOARD_SQL),
    "dashboard_incremental": _with("counted catalog", _DASHBOARD_SQL),
    "analytics_bundle": _with(
        "counted catalog",
        "\nUNION ALL ".join(
            [
                _summary_part("counted"),
                _part(
                    "sentiment",
                    _counts("counted", "sentiment"),
                    "sentiment",
                    review_count="review_count",
                ),
                _part(
                    "products",
                    _named(_ranking("counted", MOST, 1)),
                    "product_id",
                    review_count="review_count",
                    average_score="average_score",
                    product_name="product_name",
                ),
            ]
        ),
    ),
    "sample_dashboard": _with("sample_reviews catalog", _SAMPLE_SQL),
    "gold_snapshot": _with(
        "counted catalog",
        f"SELECT *, 'cached' AS status, true AS stale FROM ({_DASHBOARD_SQL})",
    ),
    "gold_completeness": _with(
        "counted catalog",
        "SELECT report, true AS complete, count(d.report_name) AS rows"
        f" FROM (VALUES {_COMPLETE}) AS n(report) LEFT JOIN"
        f" (SELECT report AS report_name FROM ({_DASHBOARD_SQL})) AS d"
        " ON d.report_name = n.report GROUP BY report",
    ),
    # streaming
    "stream_source_replay": _with(
        "records",
        "SELECT kafka_key AS key, json_value AS value, topic, partition, \"offset\","
        " kafka_timestamp AS timestamp FROM records",
    ),
    "stream_parse": _PARSED,
    "stream_bronze": _BRONZE,
    "stream_silver": _STREAM_SILVER,
    "stream_fanout": _STREAM_SILVER,
    "silver_compacted": _STREAM_SILVER,
    "stream_restart": _STREAM_SILVER,
    "stream_sentiment_counts": _with(
        "stream_silver", _counts("stream_silver", "sentiment")
    ),
    "stream_product_scores": _with(
        "stream_silver",
        "SELECT product_id, count(*) AS review_count,"
        " CAST(round(CAST(avg(score) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS average_score"
        " FROM stream_silver GROUP BY product_id",
    ),
    "stream_enrich_catalog": _with(
        "stream_silver catalog",
        _named("SELECT \"offset\", product_id, score FROM stream_silver"),
    ),
    "stream_dedup": _with(
        "stream_reviews",
        f"SELECT {_ORIGIN}, {_REVIEW_COLUMNS} FROM stream_reviews UNION ALL"
        f" SELECT {_ORIGIN}, {_REVIEW_COLUMNS} FROM stream_reviews WHERE review_id IS NULL",
    ),
}

# The running results are those of the complete ones.
ORACLE["stream_sentiment_running"] = ORACLE["stream_sentiment_counts"]
ORACLE["stream_product_running"] = ORACLE["stream_product_scores"]
