"""Operator 8: texts that are a known licence, found by the digest of their canonical form."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# Licence texts and notices to recognise, and spellings that licence
# matching treats as equal.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", MIT),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    # full texts in several wrappings and notices of the common licences
    *((r["license"], r["text"]) for r in map(json.loads, Path(__file__).with_name("known_licenses.jsonl").read_text("utf-8").splitlines())),
)
#: Pattern and replacement, applied in this order to lower-case text without punctuation.
SPELLINGS: tuple[tuple[str, str], ...] = (
    (r"\blicence", "license"),
    (r"\bsub license", "sublicense"),
    (r"\bnon infringement", "noninfringement"),
    (r"\backnowledgement", "acknowledgment"),
    (r"\bfavour", "favor"),
    (r"\bjudgement", "judgment"),
    (r"\bmerchantibility", "merchantability"),
    (r"\bper cent\b", "percent"),
)

#: A whole line that names a holder: "Copyright (c) 2020 Jane Doe".
_COPYRIGHT = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"


def canonical_lines(c: Column, spellings=SPELLINGS) -> Column:
    """The canonical form of a text, line by line.

    Lower case; lines that start with a copyright mark go; every run of
    characters other than letters and digits becomes one space; equal
    spellings become one. Each expression is small and native.
    """
    c = F.regexp_replace(F.lower(c), _COPYRIGHT, "")
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " ")
    for pattern, to in spellings:
        c = F.regexp_replace(c, pattern, to)
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def known_digests(spark, known=KNOWN, spellings=SPELLINGS) -> DataFrame:
    """``license`` and ``digest`` of each known text; two licences with one canonical text are an error."""
    table = spark.createDataFrame(list(known), "license string, text string")
    lines = canonical_lines(F.col("text"), spellings)
    return (
        table.select("license", F.sha2(F.array_join(lines, " "), 256).alias("digest"))
        .groupBy("digest")
        .agg(
            F.when(F.count_distinct("license") > 1, F.raise_error(F.lit("two licences share a text")).cast("string"))
            .otherwise(F.min("license"))
            .alias("license")
        )
    )


def scan_licenses(
    df: DataFrame, known=KNOWN, id_col: str = "doc_id", text_col: str = "text", spellings=SPELLINGS
) -> DataFrame:
    """Per document: ``digest`` of its canonical text, ``license`` when the entire text is known,
    and ``notices``, the sorted licences of which an entire line is a known text.

    ``known`` is a parameter of a few hundred texts; it is the bound of the
    hash join and of the lookup of lines. Documents never meet each other, so
    copies and hot sources cost nothing, and nothing is shuffled: lines are
    looked up in their own row, where most are no known digest.

    NULL and empty texts have the digest of the empty text, no licence and no
    notices, as do texts of punctuation alone. Rows that repeat stay one row
    each, also when they share an id. Other columns are not read.
    """
    table = known_digests(df.sparkSession, known, spellings)
    named = {r.digest: r.license for r in table.collect()}  # at most one row per known text
    lines = df.select(F.col(id_col).alias(id_col), canonical_lines(text_of(text_col), spellings).alias("_lines"))
    digests = lines.select(
        id_col,
        F.sha2(F.array_join("_lines", " "), 256).alias("digest"),
        F.filter(F.transform("_lines", lambda x: F.sha2(x, 256)), lambda d: d.isin(list(named))).alias("_hits"),
    )
    name = F.create_map(*[F.lit(x) for pair in named.items() for x in pair]) if named else F.create_map().cast("map<string,string>")
    found = digests.join(F.broadcast(table), "digest", "left")
    notices = F.array_sort(F.array_distinct(F.transform("_hits", lambda d: name[d])))
    return found.select(id_col, "digest", "license", notices.alias("notices"))


def oracle(known=KNOWN, spellings=SPELLINGS) -> str:
    """The same lookup in SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"

    def lines(text: str) -> str:
        c = rf"regexp_replace(lower({text}), '(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$', '', 'g')"
        c = rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
        for pattern, to in spellings:
            c = f"regexp_replace({c}, {quote(pattern)}, {quote(to)}, 'g')"
        return f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"

    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in known)
    return f"""
with known as (select distinct name, sha256(array_to_string({lines("text")}, ' ')) as digest
               from (values {values}) v(name, text)),
d as (select doc_id, {lines("coalesce(text, '')")} as ls from documents),
e as (select doc_id, sha256(array_to_string(ls, ' ')) as digest, ls from d),
u as (select doc_id, sha256(unnest(ls)) as digest from e),
n as (select doc_id, list_sort(list(distinct name)) as notices from u join known using (digest) group by doc_id)
select e.doc_id, e.digest, known.name as license, coalesce(n.notices, []::varchar[]) as notices
from e left join known on known.digest = e.digest left join n on n.doc_id = e.doc_id
"""
