"""Operator 1: allow / block verdicts of url rules, by a sort-merge range join (DataFrame functions only).

A host becomes a canonical key: its labels reversed, each ended by a dot
(``www.example.com`` -> ``com.example.www.``); behind a zero character follows the path.  A rule (host, path) is then the interval
of keys that start with its key.  Intervals are nested or disjoint.  A url is in the interval of a rule on its host or on a
domain above it under the key of that domain, so it is looked up once for each of its domains that is no deeper than any rule.

Plan
1. rules get their nesting level: the number of rules on the same host whose path starts theirs, themselves included.
2. urls' keys and rules are range-partitioned together by (key, rule before url, salt) into equal parts, which are written once; the salt
   splits a url or host that holds a third of all rows.
3. each part is sorted and swept once.  The stack of active nested rules has one slot a level: the ``last`` rule of that level
   seen so far, popped when its interval has ended, that is when the url's key does not start with the slot's key.
   What the parts before it leave on the stack is a table of at most ``parts`` rows, handed on from part to part.
4. of the rules on the stacks of a url's domains the longest wins (ties: the longer host, then block).

Rules and urls meet by sorting alone: there is no list of a host's rules and no pass of all rules over all parts, so a host may
have millions of path rules.  Slots are as many as the longest chain of rules that start each other.

Defined results: a null url, or one without ``://``, has an empty host and path
and gets the default verdict; an empty rule table gives the default for all;
repeated rows stay; null rule paths count as empty, rules without a host are ignored, as are those whose path is not empty and does
not start with a slash (no url has such a path); of rules that share host and path block wins; very long urls are compared whole;
other columns of both tables, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeshift.llm.common import shuffle_partitions
from homeshift.session import materialize

PATH_MARK = "\0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the registered query: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def host_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))
    before = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)  # up to the first ? or #
    raw = F.substring_index(before, "/", 1)
    host = F.translate(raw, UPPER, LOWER)
    return host, F.substring(before, F.length(raw) + 1, F.length(before))


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def leveled_rules(rules: DataFrame) -> DataFrame:
    """(key, level, depth, entry) of every rule that a url can meet; ``entry`` orders rules by their rank."""
    path = F.coalesce(F.col("path"), F.lit(""))
    own = rules.select(F.translate("host", UPPER, LOWER).alias("host"), path.alias("path"), "verdict").where("host != '' and (path = '' or startswith(path, '/'))")
    entry = F.struct(
        F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"), (F.col("verdict") == "block").alias("block"),
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict"),
    )
    own = own.withColumn("domain", host_key(F.col("host"))).groupBy("domain", "path").agg(F.max(entry).alias("entry"))
    starts = F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    inside = own.select("domain", F.col("path").alias("whole"), F.explode(starts).alias("path")).join(own.select("domain", "path"), ["domain", "path"])
    level = inside.groupBy("domain", F.col("whole").alias("path")).agg(F.count(F.lit(1)).cast("int").alias("level"))
    key = F.concat("domain", F.lit(PATH_MARK), "path")
    return own.join(level, ["domain", "path"]).select(key.alias("key"), "level", (F.size(F.split("domain", r"\.")) - 1).alias("depth"), "entry")


def url_verdicts(
    urls: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id", default: str = "allow"
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``urls``."""
    spark = urls.sparkSession
    parts = shuffle_partitions(spark)
    marks = materialize(leveled_rules(rules), "url-rules")
    top = marks.agg(F.coalesce(F.max("level"), F.lit(0)).alias("levels"), F.coalesce(F.max("depth"), F.lit(0)).alias("depth")).first()

    host, path = host_path(url_col)
    rows = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "url-rows")
    labels = F.reverse(F.split("host", r"\."))
    deep = F.least(F.size(labels), F.lit(top["depth"]))
    domains = F.when((F.col("host") != "") & (deep > 0), F.transform(F.sequence(F.lit(1), deep), lambda d: F.concat(F.array_join(F.slice(labels, F.lit(1), d), "."), F.lit("."))))
    keys = rows.select("row", F.explode(domains).alias("domain"), "path").select(F.concat("domain", F.lit(PATH_MARK), "path").alias("key"), F.lit(1).alias("kind"), "row")
    both = keys.unionByName(marks.select("key", F.lit(0).alias("kind"), "level", "entry"), allowMissingColumns=True)
    dealt = both.withColumn("salt", F.xxhash64("row")).repartitionByRange(parts, "key", "kind", "salt").drop("salt")
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()), "url-parts")

    slots = [f"slot{n}" for n in range(1, top["levels"] + 1)]
    rule = F.struct("key", "entry")
    mine = {s: F.when((F.col("kind") == 0) & (F.col("level") == n + 1), rule) for n, s in enumerate(slots)}
    # the stack that each part leaves, and the one it finds: one row a part
    left = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), *[F.max(c).alias(s) for s, c in mine.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = left.select("part", *[F.last(s, ignorenulls=True).over(before).alias(f"{s}_before") for s in slots])
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dealt.select("*", *[F.last(c, ignorenulls=True).over(sweep).alias(s) for s, c in mine.items()]).where("kind = 1")
    swept = swept.join(F.broadcast(found), "part")  # at most `parts` rows
    stack = [F.coalesce(F.col(s), F.col(f"{s}_before")) for s in slots]
    active = [F.when(F.startswith(F.col("key"), c["key"]), c["entry"]) for c in stack]
    none = F.lit(None).cast(marks.schema["entry"].dataType)
    best = swept.select("row", F.array_max(F.array(none, *active)).alias("best")).groupBy("row").agg(F.max("best").alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )


ORACLE_SQL = r"""
with u as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), h as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_extract(rest, '^[^?#]*') as before from u
), p as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         substr(before, length(raw) + 1) as path from h
), r(rhost, rpath, rverdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m as (
  select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(rverdict, length(rhost || rpath)) as verdict
  from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id
)
select p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') as verdict from p left join m using (page_id)
"""
