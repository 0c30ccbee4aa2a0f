"""License scan by ordered signature rules, in DataFrame functions alone.

One pass collects the keywords of rules from every text. Texts with none are done; on the others
only rules whose keyword is there run, and their matches are intervals of characters. Rules of tags
run on the lines that hold an expression of identifiers, all others on the text. Where intervals
contain each other, one of a better or equal kind stays and the one inside it falls. All of it
happens in the row: nothing is shuffled.

Three base phrases, whose words stand one after the other, are found besides and always count.

Inputs: NULL text is empty. Rows come back one for one with their doc_id whatever it is; other
columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.llm.license_rules import CONFIDENCE, EXPRESSION, KINDS, rules

# Base phrases and their labels: fixed values.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# A word of each phrase that is a keyword of some rule.
BASE_KEYWORDS = ("cc", "general", "reserved")
BASE_CONFIDENCE = 0.4

_APART = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WORD = f"[^{_APART}]"


def base_pattern(phrase: str) -> str:
    letters = [f"(?i:{word})" for word in phrase.split()]
    return f"(?<!{WORD}){f'[{_APART}]+'.join(letters)}(?!{WORD})"


def keyword_pattern() -> str:
    """Any keyword of a rule at the start of a word, the longest where several start. Keywords are
    grouped by their first letter, so at most words one test of a letter ends the attempt. Every base
    phrase has a keyword of some rule, too."""
    groups: dict[str, list[str]] = {}
    for keyword in sorted({r.keyword for r in rules()}, key=lambda k: (-len(k), k)):
        groups.setdefault(keyword[0], []).append(keyword[1:].replace(".", "\\."))
    parts = (f"{first}(?:{'|'.join(rest)})" for first, rest in sorted(groups.items()))
    # Behind a keyword may stand a digit or a letter of `gplv2` and `openrail`, no other letter.
    return f"(?i)(?<![A-Za-z0-9])(?:{'|'.join(parts)})(?![A-QS-UW-Za-qs-uw-z])"


def _rule_table() -> Column:
    listed = [
        {"keyword": r.keyword, "pattern": r.pattern, "tier": r.tier, "rank": r.order, "label": r.label,
         "confidence": CONFIDENCE[r.kind]}
        for r in rules()
    ]
    kind = "array<struct<keyword:string,pattern:string,tier:int,rank:int,label:string,confidence:double>>"
    return F.from_json(F.lit(json.dumps(listed)), kind)


def spans(text: Column, pattern: Column) -> Column:
    """Start and end (in code points, from 0) of each match: what stands between the matches and
    the matches themselves, put end to end."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.arrays_zip(between.alias("b"), found.alias("f"))
    kind = "array<struct<start:int,stop:int>>"

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["b"])
        stop = start + F.length(pair["f"])
        one = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.concat(state["found"], one).alias("found"))

    first = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), kind).alias("found"))
    ends = F.aggregate(F.slice(pairs, 1, F.size(found)), first, step)
    return F.when(F.size(found) > 0, ends["found"]).otherwise(F.from_json(F.lit("[]"), kind))


def _detections(text: Column, keywords: Column) -> Column:
    """Matches of all rules whose keyword the text has, in the order that settles overlaps."""
    active = F.filter(_rule_table(), lambda r: F.array_contains(keywords, r["keyword"]))
    whole = F.array(F.struct(F.lit(0).alias("start"), text.alias("words")))

    def in_part(rule: Column, part: Column) -> Column:
        return F.transform(
            spans(part["words"], rule["pattern"]),
            lambda s: F.struct(
                (part["start"] + s["start"]).alias("start"), (-(part["start"] + s["stop"])).alias("turned"),
                rule["tier"].alias("tier"), rule["rank"].alias("rank"), rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
            ),
        )

    def of_rule(rule: Column) -> Column:
        parts = F.when(rule["tier"] == KINDS.index("tag"), F.col("expressions")).otherwise(whole)
        return F.flatten(F.transform(parts, lambda part: in_part(rule, part)))

    return F.array_sort(F.flatten(F.transform(active, of_rule)))


def _expressions(text: Column) -> Column:
    """Start and words of the lines in which tags are looked for."""
    return F.transform(
        spans(text, F.lit(EXPRESSION)),
        lambda s: F.struct(
            s["start"].alias("start"), F.substring(text, s["start"] + 1, s["stop"] - s["start"]).alias("words")
        ),
    )


def _settled(detections: Column) -> Column:
    """Labels and best confidence of the detections that no other suppresses.

    Sorted by start, then the longer first, then the better: whatever contains an interval comes
    before it. So it falls if among those before it one of a better or equal kind reaches as far.
    """

    def step(state: Column, found: Column) -> Column:
        stop = -found["turned"]
        falls = F.exists(F.slice(state["reach"], 1, found["tier"] + 1), lambda r: r >= stop)
        reach = F.transform(
            state["reach"], lambda r, k: F.when(k == found["tier"], F.greatest(r, stop)).otherwise(r)
        )
        grown = F.struct(
            reach.alias("reach"),
            F.array_union(state["labels"], F.array(found["label"])).alias("labels"),
            F.greatest(state["best"], found["confidence"]).alias("best"),
        )
        return F.when(falls, state).otherwise(grown)

    first = F.struct(
        F.array_repeat(F.lit(-1), len(KINDS)).alias("reach"),
        F.from_json(F.lit("[]"), "array<string>").alias("labels"),
        F.lit(0.0).alias("best"),
    )
    return F.aggregate(detections, first, step)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, the base places (n_base, first_word, last_word, base_labels), all labels
    and the score: the best confidence of what stands."""
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    nothing = F.from_json(F.lit("[]"), "array<string>")
    lowered = F.transform(F.regexp_extract_all("text", F.lit(keyword_pattern()), F.lit(0)), lambda k: F.lower(k))
    kept = slim.select("doc_id", "text", F.array_distinct(lowered).alias("keywords"))
    none = F.from_json(F.lit("[]"), "array<struct<start:int,stop:int>>")
    for k, ((phrase, _), keyword) in enumerate(zip(BASE, BASE_KEYWORDS, strict=True)):
        there = F.array_contains("keywords", keyword)
        places = F.when(there, spans(text, F.lit(base_pattern(phrase)))).otherwise(none)
        kept = kept.withColumn(f"base_{k}", F.transform(places, lambda s: s["start"]))
    lines = F.when(F.array_contains("keywords", "spdx"), _expressions(text))
    nowhere = F.from_json(F.lit("[]"), "array<struct<start:int,words:string>>")
    kept = kept.withColumn("expressions", F.coalesce(lines, nowhere))
    settled = F.when(F.size("keywords") > 0, _settled(_detections(text, F.col("keywords"))))
    kept = kept.withColumn("settled", settled)
    base = F.concat(*(F.col(f"base_{k}") for k in range(len(BASE))))
    base_labels = F.filter(
        F.array(*(F.when(F.size(f"base_{k}") > 0, label) for k, (_, label) in enumerate(BASE))),
        lambda x: x.isNotNull(),
    )
    kept = kept.select(
        "doc_id", "text", base.alias("base"), base_labels.alias("base_labels"),
        F.coalesce("settled.labels", nothing).alias("labels"), F.coalesce("settled.best", F.lit(0.0)).alias("best"),
    )

    def word_at(start: Column) -> Column:
        before = F.regexp_count(F.substring("text", F.lit(1), start), F.lit(f"{WORD}+"))
        return F.when(F.size("base") > 0, before.cast("long"))

    all_labels = F.array_sort(F.array_union("labels", "base_labels"))
    score = F.greatest("best", F.when(F.size("base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0)))
    return kept.select(
        "doc_id", F.regexp_count("text", F.lit(f"{WORD}+")).cast("long").alias("n_words"),
        F.size("base").cast("long").alias("n_base"), word_at(F.array_min("base")).alias("first_word"),
        word_at(F.array_max("base")).alias("last_word"),
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"), score.alias("score"),
    )
