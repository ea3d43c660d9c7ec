"""License scans by ordered signature rules, in DataFrame functions only.

A rule is a regular expression over the words of a text (lower-cased, one blank between), anchored at its first word. Rules are made
from ``NAMES`` and ``FORMS``: a hand-written pattern per license, put into each hand-written way of granting it; ``BODIES`` are texts and headers of
licenses, with or without a name. Three gates keep
them off most text: substrings of the whole text, then words a rule may begin with, then the rules of that word only. Each match is an interval of words.

Overlaps are resolved by priority and containment: a detection goes when another one of higher priority, or of the same priority and
earlier in the order of start, length and rule, contains its interval. Base phrases are counted before that, and their labels always stay.

The rules are a fixed table (``rules()``, some hundreds of rows), which is the only thing sent to all tasks. Texts without a
keyword never leave their place; detections of the others, not texts, are shuffled by row.

Rows: one row out per row in. Null and empty texts have no words. Texts are scanned whole; repeated rows each give their own row;
an empty table gives an empty table. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

from functools import lru_cache
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of the lower-cased text: everything but ASCII that is neither letter nor digit parts them.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
REACH = 20

#: Phrases and labels of the base, as given.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: A blank or the end of the window. ``$`` would also match before a line separator, which is part of a word here.
_ENDS = r"(?: |(?![\s\S]))"
_V = r"(?: (?:version|v|ver))?"
_N = r"(?: v?\d+(?: \d+){0,2})"
#: License label and its name in words. Versions follow by ``_V`` and ``_N``.
NAMES = (
    ("apache-2.0", rf"apache(?: software)?(?: license)?{_V}(?: v?2(?: 0)?)"),
    ("apache", rf"apache(?: software)?(?: license)?(?:{_V}{_N})?"),
    ("mit", r"(?:mit|expat|x11)(?: license)?"),
    ("bsd-2-clause", r"(?:(?:2|two) clause|simplified|freebsd) bsd(?: license)?|bsd 2 clause(?: license)?"),
    ("bsd-3-clause", r"(?:(?:3|three) clause|new|modified|revised) bsd(?: license)?|bsd 3 clause(?: license)?"),
    ("bsd", r"bsd(?: style)?(?: license)?"),
    ("agpl", rf"(?:gnu )?(?:affero (?:general public license|gpl)|agpl)(?:{_V}{_N})?"),
    ("lgpl", rf"(?:gnu )?(?:(?:lesser|library) (?:general public license|gpl)|lgpl)(?:{_V}{_N})?"),
    ("gpl-2.0", rf"(?:gnu )?(?:general public license|gpl){_V} v?2(?: 0)?"),
    ("gpl-3.0", rf"(?:gnu )?(?:general public license|gpl){_V} v?3(?: 0)?"),
    ("gpl", rf"(?:gnu )?(?:general public license|gpl)(?:{_V}{_N})?"),
    ("gfdl", rf"(?:gnu )?(?:free documentation license|fdl|gfdl)(?:{_V}{_N})?"),
    ("mpl", rf"(?:mozilla public license|mpl)(?:{_V}{_N})?"),
    ("epl", rf"(?:eclipse public license|epl)(?:{_V}{_N})?"),
    ("cddl", rf"(?:common development and distribution license|cddl)(?:{_V}{_N})?"),
    ("cpl", rf"common public license(?:{_V}{_N})?"),
    ("eupl", rf"(?:european union public licen[cs]e|eupl)(?:{_V}{_N})?"),
    ("isc", r"isc(?: license)?"),
    ("zlib", r"zlib(?: libpng)?(?: license)?"),
    ("artistic", rf"artistic license(?:{_V}{_N})?"),
    ("boost", rf"boost software license(?:{_V}{_N})?"),
    ("python", r"(?:python software foundation|psf) license"),
    ("ofl", rf"(?:sil )?open font license(?:{_V}{_N})?"),
    ("ms-pl", r"microsoft public license"),
    ("ms-rl", r"microsoft reciprocal license"),
    ("unlicense", r"unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to public license"),
    ("odbl", rf"(?:open (?:data commons )?database license|odbl)(?:{_V}{_N})?"),
    ("cc0", rf"(?:cc0|cc zero|creative commons zero)(?:{_V}{_N})?"),
    ("cc-by-nc-nd", rf"(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)(?:{_N})?"),
    ("cc-by-nc-sa", rf"(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)(?:{_N})?"),
    ("cc-by-nc", rf"(?:cc|creative commons) (?:by nc|attribution non ?commercial)(?:{_N})?"),
    ("cc-by-nd", rf"(?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s?)(?:{_N})?"),
    ("cc-by-sa", rf"(?:cc|creative commons) (?:by sa|attribution share ?alike)(?:{_N})?"),
    ("cc-by", rf"(?:cc by|creative commons attribution)(?:{_N})?"),
    ("public-domain", r"public domain"),
    ("sspl", r"server side public license|sspl"),
    ("elastic", rf"elastic license(?:{_V}{_N})?"),
    ("busl", rf"business source license(?:{_V}{_N})?"),
)
#: Ways to grant a license: words before and after its name, priority (1 goes first) and weight.
FORMS = (
    (r"licensed under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?(?: or(?: \w+){1,3} later(?: version)?)?", 1, 0.95),
    (r"released under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.95),
    (r"(?:re)?distribute[d]? (?:it )?(?:and or modify it )?under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.95),
    (r"available under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.9),
    (r"published under (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.9),
    (r"covered by (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.85),
    (r"subject to (?:the )?(?:terms of )?(?:the )?(?:gnu )?", r"(?: license)?", 1, 0.85),
    (r"dedicated to (?:the )?", r"", 1, 0.9),
    (r"spdx license identifier ", r"(?: only| or later)?", 1, 1.0),
    (r"license ", r"(?: license)?", 2, 0.6),
    (r"", r"", 3, 0.5),
)
#: Texts and headers of licenses that need not name them: label, words, priority and weight. At most ``REACH`` words each.
BODIES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 2, 0.9),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", 2, 0.9),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 2, 0.9),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose", 2, 0.8),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1, 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 2, 0.9),
    ("bsd-3-clause", r"neither the names? of(?: [^ ]+){1,8} nor the names of (?:its|their|any|other) contributors", 2, 0.9),
    ("openssl", r"redistributions of any form whatsoever must retain the following acknowledge?ment", 2, 0.9),
    ("zlib", r"altered source versions must be plainly marked as such", 2, 0.9),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license", 2, 0.9),
    ("gpl", r"free software you can redistribute it and or modify it under the terms of the gnu general public license", 1, 0.95),
    ("lgpl", r"free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 1, 0.95),
    ("agpl", r"free software you can redistribute it and or modify it under the terms of the gnu affero general public license", 1, 0.95),
    ("unlicense", r"unencumbered software released into the public domain", 1, 0.95),
    ("cc0", r"waived all copyright and related or neighbou?ring rights", 2, 0.9),
    ("ofl", r"reserved font name", 2, 0.7),
    ("artistic", r"intent of this document is to state the conditions under which a package may be copied", 2, 0.9),
    ("epl", r"accompanying program is provided under the terms of this eclipse public license", 1, 0.95),
    ("cpl", r"accompanying program is provided under the terms of this common public license", 1, 0.95),
)
#: Words that a form may begin with; the empty form begins with the name, whose first words are listed here.
FORM_WORDS = ("licensed", "released", "distribute distributed redistribute redistributed", "available", "published", "covered", "subject", "dedicated", "spdx", "license")
NAME_WORDS = {
    "apache-2.0": "apache", "apache": "apache", "mit": "mit expat x11", "bsd-2-clause": "2 two simplified freebsd bsd", "bsd-3-clause": "3 three new modified revised bsd",
    "bsd": "bsd", "agpl": "gnu affero agpl", "lgpl": "gnu lesser library lgpl", "gpl-2.0": "gnu general gpl", "gpl-3.0": "gnu general gpl", "gpl": "gnu general gpl",
    "gfdl": "gnu free fdl gfdl", "mpl": "mozilla mpl", "epl": "eclipse epl", "cddl": "common cddl", "cpl": "common", "eupl": "european eupl", "isc": "isc", "zlib": "zlib",
    "artistic": "artistic", "boost": "boost", "python": "python psf", "ofl": "sil open", "ms-pl": "microsoft", "ms-rl": "microsoft", "unlicense": "unlicense", "wtfpl": "wtfpl do",
    "odbl": "open odbl", "cc0": "cc0 cc creative", "public-domain": "public", "sspl": "server sspl", "elastic": "elastic", "busl": "business",
}
#: Bare names that are ordinary words; they count within a form only.
_TOO_SHORT = ("mit", "isc", "zlib", "bsd", "apache", "epl", "mpl")
#: Substrings of the lower-cased text; the matches of a rule contain one of them or of ``KEYWORD_PATTERN``.
KEYWORDS = ("licen", "gpl", "fdl", "mpl", "epl", "cddl", "eupl", "cc0", "creative", "odbl", "sspl", "wtfpl", "spdx", "rights")
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEYWORD_PATTERN = rf"cc{_GAP}(?:by|zero)|general{_GAP}public|public{_GAP}domain|under{_GAP}|covered{_GAP}by|subject{_GAP}to"

#: A body's match contains a keyword, or one of these words and then ``BODY_PATTERN``.
BODY_WORDS = ("hereby", "binary", "whatsoever", "plainly", "writing", "unencumbered", "documentation", "contributors", "font", "package")
BODY_PATTERN = (
    rf"hereby{_GAP}granted|binary{_GAP}forms|form{_GAP}whatsoever|plainly{_GAP}marked|to{_GAP}in{_GAP}writing|unencumbered{_GAP}software"
    rf"|its{_GAP}documentation|contributors|reserved{_GAP}font|package{_GAP}may"
)


@lru_cache(maxsize=1)
def rules() -> list[tuple[int, str, str, str, int, float, bool]]:
    """``rule, anchor word, pattern, label, priority, weight, base``: every rule once for each word it may begin with."""
    out, number = [], 0
    for phrase, label in BASE:
        out.append((number, phrase.split()[0], rf"^({phrase}){_ENDS}", label, 3, 0.5, True))
        number += 1
    for label, body, priority, weight in BODIES:
        out.append((number, body.split()[0], rf"^({body}){_ENDS}", label, priority, weight, False))
        number += 1
    for k, (before, after, priority, weight) in enumerate(FORMS):
        for label, name in NAMES:
            bare = not before
            if bare and label in _TOO_SHORT:
                name = rf"(?:{name}) license" if "license" not in name else name.replace("(?: license)?", " license")
            words = NAME_WORDS.get(label, "cc creative") if bare else FORM_WORDS[k]
            for anchor in words.split():
                out.append((number, anchor, rf"^({before}(?:{name}){after}){_ENDS}", label, priority, weight, False))
            number += 1
    return out


def _prefilter(lowered: Column) -> Column:
    hit = lowered.contains(KEYWORDS[0])
    for k in KEYWORDS[1:]:
        hit = hit | lowered.contains(k)
    body = lowered.contains(BODY_WORDS[0])
    for k in BODY_WORDS[1:]:
        body = body | lowered.contains(k)
    return hit | lowered.rlike(KEYWORD_PATTERN) | (body & lowered.rlike(BODY_PATTERN))


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, start, stop, label, rule, priority, weight, base`` of the rows that pass the prefilter.

    A row without a detection stands there once with nulls.
    """
    spark = docs.sparkSession
    anchors = sorted({r[1] for r in rules()})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # The gate may take all of Unicode for lower case, which lets a few texts more through; words are lower-cased as ASCII.
    gated = docs.where(_prefilter(F.lower(text)))
    rows = gated.select(F.col(id_col).cast("long").alias("doc_id"), F.translate(text, ascii_uppercase, ascii_lowercase).alias("_text"))
    words = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("w"))
    places = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("anchor"))), lambda x: x["anchor"].isin(anchors))
    spots = F.transform(places, lambda x: F.struct(x["at"].cast("long").alias("start"), x["anchor"].alias("anchor"), F.array_join(F.slice("w", x["at"] + 1, REACH), " ").alias("window")))
    each = words.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.inline_outer(spots))
    table = spark.createDataFrame(rules(), "rule int, anchor string, pattern string, label string, priority int, weight double, base boolean")
    matched = each.join(F.broadcast(table), (each.anchor == table.anchor) & F.expr("window rlike pattern"), "left")
    length = F.size(F.split(F.expr("regexp_extract(window, pattern, 1)"), " "))
    return matched.select("row", "doc_id", "n_words", "start", (F.col("start") + length).alias("stop"), "label", "rule", "priority", "weight", "base")


def unsuppressed(found: DataFrame) -> DataFrame:
    """``found`` with ``kept``: no other detection of the row suppresses it. Base detections suppress nothing and stay."""
    earlier = Window.partitionBy("row").orderBy("start", F.desc("stop"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(False)
    for level in (1, 2, 3):
        reach = F.max(F.when((F.col("priority") == level) & ~F.col("base"), F.col("stop"))).over(earlier)
        covered = covered | ((F.col("priority") >= level) & (F.coalesce(reach, F.lit(-1)) >= F.col("stop")))
    return found.withColumn("kept", F.col("rule").isNotNull() & (F.col("base") | ~covered))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every document."""
    found = unsuppressed(detections(docs, id_col, text_col))
    base = F.col("base") & F.col("rule").isNotNull()
    names = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    scanned = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("kept")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("kept"), F.col("weight"))), F.lit(0.0)).alias("score"),
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.lit(None).cast("long")
    others = docs.where(~_prefilter(F.lower(text))).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_base"), none.alias("first_word"), none.alias("last_word"),
        F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"),
    )
    return scanned.drop("row").unionByName(others)
