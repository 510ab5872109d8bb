"""License notices found by ordered signature rules.

A text is reduced to its words in lower case.  Each of some hundred rules is a regular expression over them with
a label, a priority, and keywords one of which it needs as a word of the text, as a mention of a license also needs
"under" or "license"; only rules whose words the text has are tried, so most texts try none.  Of two detections one of which lies
within the other, the inner one goes unless its rule has the higher priority.  The score is
the confidence of the strongest rule that is left.

All of it is SQL expressions within a row: no shuffle and nothing collected.  Null texts count as
empty and have no words and no labels.  Very long texts and many detections are handled in their row.
Repeated rows and null ids are returned as they are.  An empty table gives no rows.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Letters whose lower case begins with one of a to z.
TO_ASCII = ("\u0130", "\u212a")
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases whose places are counted, and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Label, keyword, how the license is named in running text, its SPDX words.
LICENSES = (
    ("mit", "mit", "mit(?: x11)?", "mit"),
    ("mit", "expat", "expat", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("x11", "x11", "x11", "x11"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", "apache 2 0"),
    ("bsd-2", "bsd", "(?:bsd 2(?: clause)?|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:bsd 3(?: clause)?|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:bsd 4(?: clause)?|4 clause bsd|original bsd|old bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd)", "0bsd"),
    ("bsd", "bsd", "bsd(?: style)?", "bsd"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost", "boost", "boost(?: software)?(?: license)?(?: version)?(?: 1 0)?", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("gpl-1", "gnu", "gnu (?:gpl|general public license)(?: version| v)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "gnu", "gnu (?:gpl|general public license)(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-2", "gpl", "(?:gpl ?v? ?2|gplv2)(?: 0)?", "gpl 2 0"),
    ("gpl-3", "gnu", "gnu (?:gpl|general public license)(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-3", "gpl", "(?:gpl ?v? ?3|gplv3)(?: 0)?", "gpl 3 0"),
    ("gpl", "gnu", "gnu (?:gpl|general public license)", "gpl"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?2(?: 1)?", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.1", "lesser", "gnu lesser general public license(?: version| v)? ?2(?: 1)?", "lgpl 2 1"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-3", "lesser", "gnu lesser general public license(?: version| v)? ?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public license", "lgpl"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version| v)?(?: ?3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("agpl-3", "agpl", "(?:gnu )?agpl(?: version| v)?(?: ?3(?: 0)?)?", "agpl 3 0"),
    ("gfdl", "documentation", "gnu free documentation license", "gfdl 1 [123]"),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? ?1(?: [01])?", "mpl 1 1"),
    ("mpl-2", "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("mpl-2", "mpl", "mpl(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    ("epl-1", "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    ("epl-2", "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    ("edl", "eclipse", "eclipse distribution license", "edl 1 0"),
    ("cddl", "cddl", "cddl", "cddl 1 [01]"),
    ("cddl", "distribution", "common development and distribution license", "cddl 1 [01]"),
    ("cpl", "common", "common public license", "cpl 1 0"),
    ("ipl", "ibm", "ibm public license", "ipl 1 0"),
    ("eupl", "european", "european union public licen[cs]e", "eupl 1 [12]"),
    ("artistic-1", "artistic", "artistic license(?: version)? ?1(?: 0)?", "artistic 1 0"),
    ("artistic-2", "artistic", "artistic license(?: version)? ?2(?: 0)?", "artistic 2 0"),
    ("perl", "perl", "same terms as perl(?: itself)?", "perl"),
    ("python", "python", "python software foundation(?: license)?", "psf 2 0"),
    ("php", "php", "php(?: license)?(?: version)? 3(?: 0[01])?", "php 3 01"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("curl", "curl", "curl", "curl"),
    ("ofl", "font", "(?:sil )?open font license", "ofl 1 1"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa", "ncsa"),
    ("afl", "academic", "academic free license", "afl 3 0"),
    ("osl", "open", "open software license", "osl 3 0"),
    ("odbl", "database", "open (?:data commons )?(?:open )?database license", "odbl 1 0"),
    ("cc0", "cc0", "cc0(?: 1 0)?", "cc0 1 0"),
    ("cc0", "commons", "creative commons zero", "cc0 1 0"),
    ("cc-by", "cc", "cc by(?: [1234] 0)?", "cc by [1234] 0"),
    ("cc-by", "commons", "creative commons attribution(?: [1234] 0)?", "cc by [1234] 0"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234] 0)?", "cc by sa [1234] 0"),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1234] 0)?", "cc by sa [1234] 0"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234] 0)?", "cc by nd [1234] 0"),
    ("cc-by-nd", "commons", "creative commons attribution no ?deriv(?:ative)?s(?: works)?", "cc by nd [1234] 0"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234] 0)?", "cc by nc [1234] 0"),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1234] 0)?", "cc by nc [1234] 0"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234] 0)?", "cc by nc sa [1234] 0"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non ?commercial share ?alike", "cc by nc sa [1234] 0"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234] 0)?", "cc by nc nd [1234] 0"),
    ("cc-by-nc-nd", "commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc by nc nd [1234] 0"),
    ("public-domain", "domain", "public domain", "public domain"),
)

# Sentences of the license texts themselves.
NOTICES = (
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-2", "either", "either version 2 of the license or at your option any later version"),
    ("gpl-3", "either", "either version 3 of the license or at your option any later version"),
    ("lgpl", "library", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl-3", "affero", "under the terms of the gnu affero general public license"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost", "boost", "distributed under the boost software license version 1 0"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("public-domain", "dedicate", "dedicate any and all copyright interest in the software to the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("proprietary", "prohibited", "unauthorized copying of this file via any medium is strictly prohibited"),
)

# How licenses are mentioned: priority, form, and words one of which the form needs.  NAME and SPDX stand for the words above.
LICENSE_WORDS = ("license", "licence", "licenses", "licences")
MENTIONS = (
    (4, "spdx license identifiers? SPDX", ("identifier", "identifiers")),
    (3, "(?:licensed|released|distributed|available|published|provided) under (?:(?:the|a|an) )?(?:terms of (?:the )?)?NAME(?: licen[cs]es?)?", ("under",)),
    (2, "under (?:the )?(?:terms of (?:the )?)?NAME(?: licen[cs]es?)?", ("under",)),
    (1, "NAME(?: style)? licen[cs]es?", LICENSE_WORDS),
)
# Names that also are plain words or products, which only name a license before the word itself.
PLAIN_NAMES = ("mit", "expat", "x11", "isc", "zlib", "boost", "ruby", "postgresql", "openssl", "curl")
NOTICE_PRIORITY = 5
BASE_PRIORITY = 6
# Confidence by priority, from a bare mention to a license's own text.
CONFIDENCE = (0.0, 0.6, 0.75, 0.9, 0.95, 0.97, 1.0)


def gate_words(keyword: str) -> list[str]:
    """The words by which a keyword may stand in a text: alone, run together with a version, or in a known compound."""
    versions = [f"{keyword}{v}{n}" for v in ("", "v") for n in ("1", "2", "3")]
    compounds = [word for word in ("freebsd", "0bsd") if keyword in word]
    return [keyword, f"{keyword}v", *versions, *compounds]


def _named(form: str, name: str, keyword: str, label: str) -> str:
    if keyword in PLAIN_NAMES and label == keyword or keyword == "expat":
        form = form.replace("NAME(?: licen[cs]es?)?", "NAME licen[cs]es?")
    return form.replace("NAME", name)


def rules() -> list[dict]:
    """All rules in order: base phrases, notices, then every license in every form of mention."""
    found = [(BASE_PRIORITY, label, label.split("-")[0], phrase, ()) for phrase, label in BASE_PHRASES]
    found += [(NOTICE_PRIORITY, label, word, text, ()) for label, word, text in NOTICES]
    for priority, form, needs in MENTIONS:
        for label, word, name, spdx in LICENSES:
            keyword = "spdx" if "SPDX" in form else word
            found.append((priority, label, keyword, _named(form, name, word, label).replace("SPDX", spdx), needs))
    return [
        {
            "rule": at,
            "base": priority == BASE_PRIORITY,
            "priority": priority,
            "label": label,
            "keyword": keyword,
            "keywords": gate_words(keyword),
            "needs": list(needs),
            "pattern": f"(?<= ){pattern}(?= )",
        }
        for at, (priority, label, keyword, pattern, needs) in enumerate(found)
    ]


RULE_TYPE = "array<struct<rule:int,base:boolean,priority:int,label:string,keywords:array<string>,needs:array<string>,pattern:string>>"
SPAN_TYPE = "array<struct<start:long,before_end:long,lower:int,rule:int,base:boolean,label:string>>"


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _spans(words: Column, rule: Column) -> Column:
    """Where a rule matches: its words' start and end, in the order that suppression wants.

    The text is cut at the matches; the spaces of the pieces number the words.
    """
    pairs = F.arrays_zip(
        F.split(words, rule["pattern"]).alias("piece"),
        F.regexp_extract_all(words, rule["pattern"], F.lit(0)).alias("found"),
    )
    empty = F.struct(
        F.lit(-1).cast("long").alias("at"), F.array().cast(SPAN_TYPE).alias("spans")
    )

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + _spaces(pair["piece"])
        end = start + _spaces(pair["found"]) + 1
        span = F.struct(
            start.alias("start"),
            (-end).alias("before_end"),
            (-rule["priority"]).alias("lower"),
            rule["rule"].alias("rule"),
            rule["base"].alias("base"),
            rule["label"].alias("label"),
        )
        return F.struct(
            (end - 1).alias("at"), F.array_append(acc["spans"], span).alias("spans")
        )

    found = F.filter(pairs, lambda pair: pair["found"].isNotNull())
    return F.aggregate(found, empty, add, lambda acc: acc["spans"])


def _outermost(spans: Column) -> Column:
    """Labels and best priority of the spans that no other span of its priority or more contains.

    Spans come by start, longest first, so a span lies within an earlier one if its end does not pass
    the furthest end so far.
    """
    levels = range(1, BASE_PRIORITY + 1)
    start = F.struct(
        *[F.lit(-1).cast("long").alias(f"end{p}") for p in levels],
        F.array().cast("array<string>").alias("labels"),
        F.lit(0).alias("best"),
    )

    def step(acc: Column, span: Column) -> Column:
        priority, end = -span["lower"], -span["before_end"]
        reach = F.greatest(
            F.lit(-1).cast("long"),
            *[F.when(priority <= p, acc[f"end{p}"]).otherwise(-1) for p in levels],
        )
        stays = end > reach
        return F.struct(
            *[
                F.when(stays & (priority == p), F.greatest(acc[f"end{p}"], end))
                .otherwise(acc[f"end{p}"])
                .alias(f"end{p}")
                for p in levels
            ],
            F.when(stays, F.array_union(acc["labels"], F.array(span["label"])))
            .otherwise(acc["labels"])
            .alias("labels"),
            F.when(stays, F.greatest(acc["best"], priority)).otherwise(acc["best"]).alias("best"),
        )

    return F.aggregate(spans, start, step)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document.

    ``spans`` holds every detection (start and end word, label, priority, rule), ``labels`` the labels
    left after suppression together with those of the base phrases.
    """
    table = rules()
    signatures = F.from_json(F.lit(json.dumps(table)), RULE_TYPE)
    gates = sorted({word for rule in table for word in (*rule["keywords"], *rule["needs"])})
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    # Lower case of all letters costs less than of A to Z alone, and no word of a rule differs, unless a letter beyond ASCII
    # has one within it.
    alike = reduce(and_, (~F.contains(text, F.lit(letter)) for letter in TO_ASCII))
    lowered = F.when(alike, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    pieces = F.split(lowered, NOT_WORD)
    gated = F.array_intersect("pieces", F.array(*(F.lit(word) for word in gates)))
    joined = F.array_join(F.array_remove("pieces", ""), " ")
    tried = F.filter(
        signatures,
        lambda rule: F.arrays_overlap(F.col("gated"), rule["keywords"])
        & ((F.size(rule["needs"]) == 0) | F.arrays_overlap(F.col("gated"), rule["needs"])),
    )
    none = F.array().cast(SPAN_TYPE)
    spans = F.sort_array(F.flatten(F.transform(tried, lambda rule: _spans(F.col("words"), rule))))
    return (
        docs.select(F.col(f"`{id_column}`"), pieces.alias("pieces"))
        # Only the first and the last piece can be empty.
        .withColumn("n_words", F.size(F.array_remove("pieces", "")).cast("long"))
        .withColumn("gated", gated)
        .withColumn("words", F.when(F.size("gated") > 0, F.concat(F.lit(" "), joined, F.lit(" "))))
        .withColumn("spans", F.when(F.size("gated") > 0, spans).otherwise(none))
        .withColumn("base_spans", F.filter("spans", lambda span: span["base"]))
        .withColumn("outer", _outermost(F.col("spans")))
        .select(
            F.col(f"`{id_column}`"),
            "n_words",
            F.size("base_spans").cast("long").alias("n_base"),
            F.array_min(F.transform("base_spans", lambda s: s["start"])).alias("first_word"),
            F.array_max(F.transform("base_spans", lambda s: s["start"])).alias("last_word"),
            F.array_sort(F.array_distinct(F.transform("base_spans", lambda s: s["label"]))).alias("base_labels"),
            F.col("outer.labels").alias("method_labels"),
            F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("outer.best") + 1).alias("score"),
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"),
                    (-s["before_end"]).alias("end"),
                    s["label"].alias("label"),
                    (-s["lower"]).alias("priority"),
                    s["rule"].alias("rule"),
                ),
            ).alias("spans"),
        )
        .withColumn("labels", F.array_sort(F.array_union("base_labels", "method_labels")))
    )
