"""License scans with a positional rare-token index.

Templates are the words of license texts and phrases. Their words form the
vocabulary; the index posts each as (word, template, position). Document
frequencies are counted over all documents. The rarest word of each phrase and of
each license text's mandatory key phrases is its anchor: a document's licence words
fetch the templates whose anchors they are, and no template is missed. Of those,
the postings of a phrase's words are intersected by relative position (place in
the document less place in the template); a phrase stands where all words agree. A
license text is reported when each of its key phrases stands in the document and
enough of its words agree on one relative position, of all those that the document
has.

Words are runs of ASCII letters and digits and of any characters beyond ASCII,
A-Z lower-cased. All of it is DataFrame expressions. Null and empty texts have no
words and score 0. Documents are judged row by row, so null and repeated ids are
fine; whole texts of any length, of which the license words, not the text, are
shuffled. Of equally good places the first counts; a license text that begins
before the document does stands at 0. Columns named like an output
column are replaced, further ones stay.
"""

from __future__ import annotations

import json
import re
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.session import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Words too common to index; in a template they hold a place that any word may take.
STOP = frozenset("a and any are by for from in is of or that the this to with".split())
#: Share of a license text's words in a document that must agree on one place.
AGREE = 0.5


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))) if w]


@dataclass(frozen=True)
class Template:
    """keys: the mandatory phrases of a license text; some word of them, and of a phrase, isn't in STOP."""

    name: str
    label: str
    text: str
    keys: tuple[str, ...] = ()

    def __post_init__(self):
        if not all(set(words_of(x)) - STOP for x in (self.text, *self.keys)):
            raise ValueError(f"{self.name}: a text or key phrase of stop words only can't be looked up")

    @property
    def words(self) -> list[str]:
        return words_of(self.text)


PHRASES = (
    Template("mit license", "mit", "mit license"),
    Template("apache license", "apache", "apache license"),
    Template("general public license", "gpl", "general public license"),
)
#: Notices and grants in the usual wording of public licenses.
TEXTS = (
    Template("cc by nc notice", "cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc by sa notice", "cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc by notice", "cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("bsd notice", "bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source", "are permitted")),
    Template("mpl notice", "mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("mit grant", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge")),
    Template("gpl version notice", "gpl", "gnu general public license version 3", ("general public license version",)),
    Template(
        "mit text",
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        ("to deal in the software without restriction", "the above copyright notice and this permission notice"),
    ),
    Template(
        "bsd conditions",
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        ("redistributions of source code must retain", "redistributions in binary form must reproduce"),
    ),
    Template(
        "bsd endorsement clause",
        "bsd-3-clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        ("to endorse or promote products", "specific prior written permission"),
    ),
    Template(
        "isc text",
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        ("with or without fee is hereby granted",),
    ),
    Template(
        "apache notice",
        "apache",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template(
        "gpl notice",
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        ("the terms of the gnu general public license", "free software foundation"),
    ),
    Template(
        "unlicense text",
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        ("free and unencumbered software",),
    ),
    Template("lgpl notice", "lgpl", "gnu lesser general public license", ("lesser general public license",)),
)


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(",")]
    data = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(data), f"array<struct<{','.join(':'.join(c.split()) for c in schema.split(','))}>>")))


def license_words(df: DataFrame, templates: tuple[Template, ...], text: str) -> DataFrame:
    """df without text, with n_words and hits: array of (at, word), the vocabulary's words by place."""
    vocabulary = sorted({w for t in templates for x in (t.text, *t.keys) for w in words_of(x)} - STOP)
    pieces = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SEPARATORS, -1), "")
    hits = F.filter(F.transform("__words", lambda w, i: F.struct(i.alias("at"), F.translate(w, string.ascii_uppercase, string.ascii_lowercase).alias("word"))), lambda x: x["word"].isin(vocabulary))
    return df.withColumn("__words", pieces).withColumn("n_words", F.size("__words").cast("long")).withColumn("__hits", hits).drop("__words", text)


def _places(words: list[str]) -> Column:
    """Where the words stand one after the other: their postings intersected by relative position. Stop words hold a place only."""
    at = lambda k, w: F.transform(F.filter("__hits", lambda x: x["word"] == w), lambda x: x["at"] - k)
    found = reduce(F.array_intersect, [at(k, w) for k, w in enumerate(words) if w not in STOP])
    return F.filter(F.array_sort(F.array_distinct(found)), lambda x: (x >= 0) & (x + len(words) <= F.col("n_words")))


def anchors(frequency: DataFrame, phrases: tuple[Template, ...], texts: tuple[Template, ...]) -> DataFrame:
    """(word, name): the word that fetches each template, the rarest of a phrase or of a text's key phrases; of a text without
    key phrases all words, since any of them may be the one that stands."""
    asked = [(t.name, w, k, not t.keys and t in texts) for t in phrases + texts for k, w in enumerate(words_of(" ".join(t.keys) or t.text)) if w not in STOP]
    posted = _table(frequency.sparkSession, asked, "name string,word string,place int,every boolean")
    counted = posted.join(F.broadcast(frequency), "word", "left").withColumn("rank", F.expr("row_number() over (partition by name order by coalesce(df, 0), place)"))
    return counted.where("rank = 1 or every").select("word", "name").distinct()


def scan(df: DataFrame, text: str = "text", phrases: tuple[Template, ...] = PHRASES, texts: tuple[Template, ...] = TEXTS) -> DataFrame:
    """Replaces text by n_words, places (array of (name, label, at): each place of each phrase), found (array of
    (name, label, at, share): each license text) and score (double: 1 with a phrase, else the best share)."""
    spark = df.sparkSession
    base = df.drop("n_words", "__hits", "__names", "places", "found", "score", "__row")
    kept = [c for c in base.columns if c != text]
    rows = materialize(license_words(base.withColumn("__row", F.monotonically_increasing_id()), phrases + texts, text), "license_words")
    words = rows.where(F.size("__hits") > 0).select("__row", F.explode(F.array_distinct(F.transform("__hits", lambda x: x["word"]))).alias("word"))
    frequency = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "frequency")  # a row for each vocabulary word at most
    fetched = words.join(F.broadcast(anchors(frequency, phrases, texts)), "word").groupBy("__row").agg(F.collect_set("name").alias("__names"))

    asked = lambda t: F.array_contains("__names", t.name)
    no_place = F.from_json(F.lit("[]"), "array<struct<name:string,label:string,at:int>>")
    one = lambda t: F.transform(_places(t.words), lambda at: F.struct(F.lit(t.name).alias("name"), F.lit(t.label).alias("label"), at.cast("int").alias("at")))
    places = F.array_sort(F.concat(no_place, *(F.when(asked(t), one(t)).otherwise(no_place) for t in phrases)))
    stands = lambda t: reduce(lambda x, k: x & (F.size(_places(words_of(k))) > 0), t.keys, asked(t))
    keyed = F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(stands(t), F.lit(t.name)) for t in texts)))
    judged = rows.join(fetched, "__row", "left").withColumn("places", F.coalesce(F.when(F.col("__names").isNotNull(), places), no_place))
    judged = judged.withColumn("__keyed", F.coalesce(F.when(F.col("__names").isNotNull(), keyed), F.array().cast("array<string>")))
    judged = materialize(judged.select(*kept, "__row", "n_words", "places", "__keyed", F.when(F.size("__keyed") > 0, F.col("__hits")).alias("__hits")), "judged")

    index = _table(spark, [(t.name, t.label, w, k) for t in texts for k, w in enumerate(t.words) if w not in STOP], "name string,label string,word string,place int")
    hits = judged.where(F.size("__keyed") > 0).select("__row", F.explode("__keyed").alias("name"), "__hits").select("__row", "name", F.inline("__hits"))
    met = hits.join(F.broadcast(index), ["name", "word"]).select("__row", "name", "label", "word", (F.col("at") - F.col("place")).alias("start"))
    held = met.groupBy("__row", "name").agg(F.count_distinct("word").alias("held"))
    agreed = met.groupBy("__row", "name", "label", "start").agg(F.count_distinct("word").alias("agreed"))
    best = agreed.groupBy("__row", "name", "label").agg(F.max_by(F.struct("start", "agreed"), F.struct("agreed", -F.col("start"))).alias("b"))
    share = (F.col("b.agreed") / F.col("held")).alias("share")
    found = best.join(held, ["__row", "name"]).select("__row", F.struct("name", "label", F.greatest(F.col("b.start"), F.lit(0)).cast("int").alias("at"), share).alias("f")).where(F.col("f.share") >= AGREE)
    by_row = found.groupBy("__row").agg(F.array_sort(F.collect_list("f")).alias("found"))
    out = judged.drop("__hits", "__keyed").join(by_row, "__row", "left").drop("__row")
    out = out.withColumn("found", F.coalesce("found", F.from_json(F.lit("[]"), "array<struct<name:string,label:string,at:int,share:double>>")))
    shares = F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))
    return out.withColumn("score", F.when(F.size("places") > 0, 1.0).otherwise(shares))
