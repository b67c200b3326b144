"""License scan: ordered signature rules behind a keyword prefilter.

A text is reduced to its words once. A single pass looks for any keyword; only texts that
have one try rules, and only the rules whose own keyword is there. Detections are word
intervals; one that lies inside another of a better (smaller) priority is dropped, so that
"gpl version 3" is not also "gpl". DataFrame functions only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases that are always found, and their labels.
BASE_PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Licenses by label: keyword (a word of every name), names (regular expressions over space-separated words) and versions.
FAMILIES = [
    ("mit", "mit", ["mit"], []),
    ("mit", "expat", ["expat"], []),
    ("apache", "apache", ["apache", "apache software"], ["1", "1 0", "1 1", "2", "2 0"]),
    ("gpl", "gpl", ["gpl", "gnu gpl"], ["1", "2", "3"]),
    ("gpl", "gnu", ["gnu general public", "gnu public"], ["1", "2", "3"]),
    ("lgpl", "lgpl", ["lgpl", "gnu lgpl"], ["2", "2 1", "3"]),
    ("lgpl", "lesser", ["gnu lesser general public", "lesser general public"], ["2", "2 1", "3"]),
    ("agpl", "agpl", ["agpl", "gnu agpl"], ["1", "3"]),
    ("agpl", "affero", ["gnu affero general public", "affero general public"], ["1", "3"]),
    ("mpl", "mozilla", ["mozilla public"], ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", ["mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", ["eclipse public"], ["1 0", "2 0"]),
    ("bsd", "bsd", ["bsd", "bsd style", "new bsd", "simplified bsd", "modified bsd"], []),
    ("isc", "isc", ["isc"], []),
    ("zlib", "zlib", ["zlib", "zlib libpng"], []),
    ("boost", "boost", ["boost software"], ["1 0"]),
    ("unlicense", "unlicense", ["unlicense"], []),
    ("artistic", "artistic", ["artistic"], ["1 0", "2 0"]),
    ("cddl", "cddl", ["cddl"], ["1 0", "1 1"]),
    ("cddl", "distribution", ["common development and distribution"], ["1 0", "1 1"]),
    ("eupl", "eupl", ["eupl"], ["1 1", "1 2"]),
    ("ofl", "ofl", ["sil ofl", "ofl"], ["1 0", "1 1"]),
    ("ofl", "font", ["sil open font", "open font"], ["1 0", "1 1"]),
    ("python", "python", ["python software foundation"], ["2"]),
    ("ms-pl", "microsoft", ["microsoft public"], []),
    ("wtfpl", "wtfpl", ["wtfpl"], ["2"]),
]

#: Wordings around a name and, where there is one, its version; the earlier, the better its priority.
WORDINGS_VERSION = [
    r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)? (?:version |v)?{version}",
    r"{name} licen[cs]e (?:version |v)?{version}",
    r"{name} (?:version |v)?{version}(?: licen[cs]e)?",
]
WORDINGS_PLAIN = [
    r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?",
    r"under the {name} licen[cs]e",
    r"{name} licen[cs]e",
]

#: Names that are written as one word with their version, by label, and the versions.
JOINED = [("gpl", ["1", "2", "3"]), ("lgpl", ["2", "2 1", "3"]), ("agpl", ["1", "3"])]

#: Rules that follow no wording: (label, keyword, pattern); every match holds the keyword.
SINGLE_RULES = [
    ("bsd-3-clause", "clause", r"bsd 3 clause|3 clause bsd"),
    ("bsd-3-clause", "neither", r"neither the name of"),
    ("bsd-2-clause", "clause", r"bsd 2 clause|2 clause bsd"),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("public-domain", "domain", r"(?:released into|dedicated to|placed in|in) the public domain"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by", "commons", r"creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("proprietary", "rights", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
]

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _joined_rules() -> list[tuple[str, str, str]]:
    """Rules for gplv3, gpl3, lgplv2 1 and the like: the first word is the keyword."""
    rows = []
    for wording in (WORDINGS_PLAIN[0], r"(?:gnu )?{name}(?: licen[cs]e)?"):
        for label, versions in JOINED:
            for version in sorted(versions, key=len, reverse=True):
                for joined in (f"{label}v{version}", f"{label}{version}"):
                    # "gplv3.0" and "gplv3+" too; the words of a line hold no marks.
                    name = joined if " " in version else joined + "(?: 0)?"
                    made = wording.replace("{name}", ("(?:gnu )?" if wording == WORDINGS_PLAIN[0] else "") + name)
                    rows.append((label + "-" + version.replace(" ", "."), joined.split()[0], made))
    return rows


def signature_rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern) of every rule; a smaller number wins."""
    rows = []
    for label, keyword, pattern in SINGLE_RULES:
        rows.append((label, keyword, pattern))
    rows += _joined_rules()
    for wording in WORDINGS_VERSION:
        for label, keyword, names, versions in FAMILIES:
            for name in names:
                for version in sorted(versions, key=len, reverse=True):
                    made = label + "-" + version.replace(" 0", "").replace(" ", ".")
                    rows.append((made, keyword, wording.format(name=name, version=version)))
    for wording in WORDINGS_PLAIN:
        for label, keyword, names, _ in FAMILIES:
            for name in names:
                rows.append((label, keyword, wording.format(name=name)))
    return [(k, *row) for k, row in enumerate(rows)]


def words_line(text: Column) -> Column:
    """The words of a text, lower case, with two spaces before and after each: ``  a  b  ``."""
    # Lowering letters beyond A-Z too changes no word's bounds and makes no a-z of the phrases.
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.regexp_replace(padded, BREAK, "  ")


def _space_pairs(line: Column) -> Column:
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.shiftright(spaces, 1).cast("long")


def word_count(piece: Column) -> Column:
    """Words of a match or of a piece between matches; these begin and end within a gap."""
    return _space_pairs(piece)


def interval_places(line: Column, pattern: Column, matches: Column) -> Column:
    """Arrays of (first word, past word) of the matches that ``pattern`` cuts out of ``line``."""
    pieces = F.transform(F.split(line, pattern), word_count)
    sizes = F.transform(matches, word_count)
    return F.transform(
        F.sequence(F.lit(1), F.size(matches)),
        lambda k: _place(pieces, sizes, k),
    )


def _total(part: Column) -> Column:
    return F.aggregate(part, F.lit(0).cast("long"), lambda a, b: a + b)


def _place(pieces: Column, sizes: Column, k: Column) -> Column:
    first = _total(F.slice(pieces, F.lit(1), k)) + _total(F.slice(sizes, F.lit(1), k - 1))
    return F.struct(first.alias("first"), (first + F.element_at(sizes, k)).alias("past"))


def _phrase_starts(line: Column, phrase: str) -> Column:
    """First words of every place of a phrase; an empty array if there is none."""
    sought = " " + phrase.replace(" ", "  ") + " "
    width = len(phrase.split())
    pieces = F.transform(F.split(line, sought), word_count)
    places = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1),
        lambda k: _total(F.slice(pieces, F.lit(1), k)) + width * (k - 1),
    )
    none = F.array().cast("array<bigint>")
    return F.coalesce(F.when(F.contains(line, F.lit(sought)), places), none)


def scan(
    docs: DataFrame,
    rules: Sequence[tuple[int, str, str, str]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: key, n_words, detections, n_base, first_word, last_word, base_labels,
    labels, score.

    ``detections`` is an array of (first, past, priority, label) in words, after suppression.
    The base phrases are counted apart and always labelled. ``score`` is the share of the
    text's words that detections cover, its square root, so a short text that is mostly a
    notice is near 1 and a text without any has 0. Null and empty texts have no words.
    Documents never meet: no shuffle; repeated rows and null keys give rows of their own.
    """
    rules = signature_rules() if rules is None else rules
    keywords = sorted({k for _, _, k, _ in rules} | {"mit", "apache", "cc"})
    any_keyword = " (?:" + "|".join(keywords) + ") "
    listed = F.from_json(
        F.lit(_as_json(rules)), "array<struct<keyword:string,rules:array<struct<priority:int,label:string,pattern:string>>>>"
    )
    rows = docs.select(F.col(key), words_line(F.col(text)).alias("_line"))
    rows = rows.withColumn("n_words", _space_pairs(F.col("_line")) - 1)
    # Few texts hold a keyword; all later columns are null for the others.
    rows = rows.withColumn("_hit", F.when(F.rlike("_line", F.lit(any_keyword)), F.col("_line")))

    starts = [_phrase_starts(F.col("_hit"), phrase) for phrase, _ in BASE_PHRASES]
    rows = rows.withColumns({f"_p{k}": places for k, places in enumerate(starts)})
    rows = rows.withColumn("_starts", F.concat(*[f"_p{k}" for k in range(len(starts))]))

    tried = F.filter(listed, lambda r: F.contains(F.col("_hit"), F.concat(F.lit(" "), r["keyword"], F.lit(" "))))
    tried = F.flatten(F.transform(tried, lambda r: r["rules"]))
    rows = rows.withColumn("_rules", F.when(F.col("_hit").isNotNull(), tried))

    def detections(rule):
        # Patterns are written with single spaces; lines have two between words.
        pattern = F.concat(F.lit(" (?:"), F.replace(rule["pattern"], F.lit(" "), F.lit("  ")), F.lit(") "))
        found = F.when(
            F.rlike(F.col("_hit"), pattern),
            interval_places(F.col("_hit"), pattern, F.regexp_extract_all(F.col("_hit"), pattern, F.lit(0))),
        )
        return F.transform(
            F.coalesce(found, F.array().cast("array<struct<first:bigint,past:bigint>>")),
            lambda at: F.struct(at["first"], at["past"], rule["priority"].alias("priority"), rule["label"].alias("label")),
        )

    rows = rows.withColumn("_all", F.flatten(F.transform("_rules", detections)))
    inside = lambda a, b: (  # noqa: E731  a lies in b, and b has the better rule or the longer interval
        (b["first"] <= a["first"]) & (a["past"] <= b["past"])
        & ((b["priority"] < a["priority"]) | (b["past"] - b["first"] > a["past"] - a["first"]))
        & ~((b["first"] == a["first"]) & (b["past"] == a["past"]) & (b["priority"] >= a["priority"]))
    )
    kept = F.filter("_all", lambda a: ~F.exists(F.col("_all"), lambda b: inside(a, b)))
    rows = rows.withColumn("detections", F.array_sort(F.coalesce(kept, F.array().cast(
        "array<struct<first:bigint,past:bigint,priority:int,label:string>>"))))
    base = F.array_compact(
        F.array(*[F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE_PHRASES)])
    )
    covered = F.aggregate(
        F.col("detections"),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, d: F.struct(
            F.greatest(s["end"], d["past"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), d["past"] - F.greatest(s["end"], d["first"]))).alias("n"),
        ),
    )["n"]
    return rows.select(
        key,
        "n_words",
        "detections",
        F.size("_starts").cast("long").alias("n_base"),
        F.array_min("_starts").alias("first_word"),
        F.array_max("_starts").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(base, F.transform("detections", lambda d: d["label"]))), ","
        ).alias("labels"),
        F.when(F.col("n_words") > 0, F.sqrt(F.least(F.lit(1.0), covered / F.col("n_words"))))
        .otherwise(F.lit(0.0))
        .alias("score"),
    )


def _as_json(rules: Sequence[tuple[int, str, str, str]]) -> str:
    filed: dict[str, list[dict]] = {}
    for priority, label, keyword, pattern in rules:
        filed.setdefault(keyword, []).append({"priority": priority, "label": label, "pattern": pattern})
    return json.dumps([{"keyword": k, "rules": r} for k, r in sorted(filed.items())])
