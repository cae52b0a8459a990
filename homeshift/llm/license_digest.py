"""Operator 9: licence scan by canonical digest lookup (DataFrame functions only).

A known licence is a whole text.  Both sides are normalised the same way: lower case, equivalent
spellings to one form, copyright lines dropped, everything but letters and digits out. The
sha-256 digest of what is left is joined with the digests of the known licences.

Three scopes are looked up for each document: the whole text; each of its lines, so that a licence notice inside a text is
found as the entire line it is; and each run of whole lines, so that a licence inside a longer text or a file header is
found however its lines are broken (but for a break that puts the word copyright first: that line counts as a copyright
line).  A run is tried only where a line starts with the first ``START`` letters of a known
licence; from there the known length is cut and digested, and it must end with a line.

The known licences are those of ``LICENSES`` (texts) and of ``known_licenses.tsv`` (name, length, first letters, digest), which
``license_digests.py`` makes from a folder of whole texts; the table is a parameter.

Shuffle: one small row a document.  The units of a document are exploded and digested in the
scan's task; only digests of a possible length go on, and the units of a row are aggregated there before
the exchange.  The table of known licences is broadcast only while it has at most
``BROADCAST_ROWS`` rows (its size is counted first); a larger one is joined by a shuffle on the digest and on the
first letters.
Skew: a line that fills the corpus is one digest against one row; a
broadcast join has no hot key, and beyond the bound AQE splits the digest's side of documents.

Defined results: null and empty texts, and texts that normalise to nothing, match nothing; repeated rows
stay; very long texts are read whole; equal digests of several known licences yield all their names; other columns of the
input, whatever their names, are ignored; an empty licence table or an empty input gives no licences or no rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000
START = 8
DIGESTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "known_licenses.tsv")

#: Equivalent spellings, applied to lower-case text (fixed values).
SPELLINGS = [("licence", "license"), ("sub-license", "sublicense"), ("copyright owner", "copyright holder"), ("&", " and "), ("©", "(c)")]

MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC_BODY = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: Known licences of the registered query: (name, whole text).
LICENSES = [
    ("MIT", "MIT License\n\nCopyright (c) <year> <holder>\n\n" + MIT_BODY),
    ("MIT", MIT_BODY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "ISC License\n\nCopyright (c) <year> <holder>\n\n" + ISC_BODY),
    ("ISC", ISC_BODY),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
]


def known_digests(path: str = DIGESTS) -> list[tuple[str, int, str, str]]:
    """(name, length, first letters, digest) of the parameter file."""
    with open(path, encoding="utf-8") as f:
        return [(n, int(size), start, d) for n, size, start, d in (line.rstrip("\n").split("\t") for line in f)]


def license_table(spark: SparkSession, known=LICENSES, digests: list[tuple[str, int, str, str]] = ()) -> DataFrame:
    """(license, size, start, digest) of whole texts, and of digests made elsewhere."""
    rows = spark.createDataFrame(list(digests), "license string, size int, start string, digest string")
    return rows.unionByName(digest_table(spark.createDataFrame(known, "license string, text string")))


def digest_table(texts: DataFrame) -> DataFrame:
    """(license, text) -> (license, size, start, digest); texts that normalise to nothing are left out."""
    t = texts.select("license", canonical(F.col("text")).alias("normal")).where("normal <> ''")
    return t.select("license", F.length("normal").alias("size"), F.substring("normal", 1, START).alias("start"), digest(F.col("normal")).alias("digest"))


def canonical(text: Column) -> Column:
    """Normal form of a text: letters and digits of its lower-case form, without copyright lines."""
    t = F.lower(text)
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, r"(?m)^[ \t]*(copyright|\(c\))[^\n]*$", "")
    return F.regexp_replace(t, r"[^\p{L}\p{N}]+", "")


def digest(normal: Column) -> Column:
    return F.when(normal != "", F.sha2(normal, 256))


def _passages(lines: Column, at: Column, known: Column) -> Column:
    """Names of the known licences that are a run of two or more of the (non-empty, canonical) lines from line ``at`` (1-based) on."""

    def found(rest: Column) -> Column:
        text = F.array_join(rest, "")

        def fits(k: Column) -> Column:
            # lengths add up until the run is long enough; it must be exactly as long as the licence
            total = F.aggregate(rest, F.lit(0), lambda n, x: F.when(n < k["size"], n + F.length(x)).otherwise(n))
            longer = F.length(F.get(rest, F.lit(0))) < k["size"]
            return longer & (total == k["size"]) & (F.sha2(F.substring(text, F.lit(1), k["size"]), 256) == k["digest"])

        return F.transform(F.filter(known, fits), lambda k: k["name"])

    def bounded(most: Column) -> Column:
        return F.get(F.transform(F.array(F.slice(lines, at, most)), found), F.lit(0))

    return bounded(F.array_max(F.transform(known, lambda k: k["size"])))  # a line has a letter at least


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, license, line_licenses, n_license_lines, passage_licenses, n_passages) of every row.

    Names of the whole text, of its lines and of its runs of lines, joined by a comma; null without a match.
    ``known``: (license, size, start, digest) or (license, text).
    """
    named = digest_table(known) if "text" in known.columns else known
    table = named.groupBy("digest", "size", "start").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("name"))
    stats = table.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("most"), F.min("size").alias("least")).first()
    starts = table.groupBy("start").agg(F.collect_list(F.struct("size", "digest", "name")).alias("known"))
    table = table.drop("start")
    if stats["n"] <= BROADCAST_ROWS:
        table, starts = F.broadcast(table), F.broadcast(starts)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), canonical), lambda x: x != "")
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), canonical(text).alias("whole"), lines.alias("lines"))
    unit = rows.select("id", "row", "lines", F.posexplode(F.concat(F.array("whole"), "lines")).alias("at", "normal"))
    size = F.length("normal")
    possible = size.between(stats["least"] or 1, stats["most"] or 0)  # a longer or shorter text has no equal among the known ones
    unit = unit.withColumns({"size": F.when(possible, size), "digest": F.when(possible, digest(F.col("normal"))), "start": F.when(F.col("at") > 0, F.substring("normal", 1, START))})
    passages = F.when(F.col("known").isNotNull(), _passages(F.col("lines"), F.col("at"), F.col("known")))
    unit = unit.join(starts, "start", "left").select("id", "row", "at", "size", "digest", passages.alias("passages"))
    found = unit.join(table, ["digest", "size"], "left")
    whole = F.max(F.when(F.col("at") == 0, F.col("name")))
    names = F.array_sort(F.collect_set(F.when(F.col("at") > 0, F.col("name"))))
    count = F.count(F.when(F.col("at") > 0, F.col("name")))
    runs = F.array_sort(F.array_distinct(F.flatten(F.collect_list("passages"))))
    n_runs = F.coalesce(F.sum(F.size("passages")), F.lit(0)).cast("bigint")
    out = found.groupBy("row", "id").agg(whole.alias("license"), names.alias("names"), count.alias("n_license_lines"), runs.alias("runs"), n_runs.alias("n_passages"))

    def joined(c: str) -> Column:
        return F.when(F.size(c) > 0, F.array_join(c, ","))

    return out.select(
        F.col("id").alias(id_col), "license", joined("names").alias("line_licenses"), "n_license_lines", joined("runs").alias("passage_licenses"), "n_passages"
    )


def oracle_sql() -> str:
    def canon(col: str) -> str:
        t = f"lower({col})"
        for a, b in SPELLINGS:
            t = f"replace({t}, '{a}', '{b}')"
        t = f"regexp_replace({t}, '(?m)^[ \\t]*(copyright|\\(c\\))[^\\n]*$', '', 'g')"
        return f"regexp_replace({t}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"

    values = ", ".join("('%s', '%s')" % (n, t.replace("'", "''")) for n, t in LICENSES)
    more = ", ".join("('%s', %d, '%s', '%s')" % r for r in known_digests())
    return f"""
with own as (select license, {canon("text")} as n from (values {values}) v(license, text)),
known as (
  select digest, size, start, string_agg(distinct license, ',' order by license) as name from (
    select license, cast(length(n) as bigint) as size, substr(n, 1, {START}) as start, sha256(n) as digest from own where n <> ''
    union all select license, cast(size as bigint), start, digest from (values {more}) w(license, size, start, digest)) group by all
), whole as (
  select doc_id, known.name as license from (select doc_id, sha256({canon("coalesce(text, '')")}) as digest from documents) left join known using (digest)
), cut as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), line as (
  select doc_id, pos, {canon("line")} as normal from (select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos from cut)
), filled as (
  select *, sum(length(normal)) over (partition by doc_id order by pos) as upto from line where normal <> ''
), lines as (
  select doc_id, string_agg(distinct name, ',' order by name) as line_licenses, count(*) as n_license_lines
  from (select doc_id, sha256(normal) as digest from filled) join known using (digest) group by doc_id
), body as (
  select doc_id, string_agg(normal, '' order by pos) as normal from filled group by doc_id
), hits as (
  select a.doc_id, k.name from filled a join known k on substr(a.normal, 1, {START}) = k.start
  join filled b on b.doc_id = a.doc_id and b.upto = a.upto - length(a.normal) + k.size and b.pos > a.pos
  join body d on d.doc_id = a.doc_id
  where sha256(substr(d.normal, cast(a.upto - length(a.normal) + 1 as bigint), k.size)) = k.digest
), runs as (
  select doc_id, string_agg(distinct name, ',' order by name) as passage_licenses, count(*) as n_passages from hits group by doc_id
)
select doc_id, license, line_licenses, coalesce(n_license_lines, 0) as n_license_lines, passage_licenses, coalesce(n_passages, 0) as n_passages
from whole left join lines using (doc_id) left join runs using (doc_id)
"""
