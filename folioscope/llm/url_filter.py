"""URL filter: a trie over reversed host labels, then path segments, with longest-match precedence.

The rule set goes to the workers in one broadcast after a check of its size;
beyond the bound the same precedence comes from equi-joins of each url's own
host suffixes and path prefixes with the rules (``by_join``).

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; what no rule fits gets the default verdict; repeated rows each
give a row; of equal rules block wins over allow; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.shared import new_folder, project, stored, tidy

#: Most bytes of rule text that are broadcast.
BROADCAST_BYTES = 32 << 20
URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def parts(url: str | None) -> tuple[str, str]:
    """Host in lower case and path."""
    found = URL.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


class Trie:
    """Nodes are dicts: host labels from the right lead down, then ``"/"`` leads to the path's trie by segment.

    A segment keeps its closing slash. A rule whose path ends inside a segment
    lies at the node above, among the open ends. Key None holds a node's rule.
    """

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root: dict = {}
        for rule in sorted(rules, key=lambda r: (r.verdict == "block", r)):  # of equal rules the last stays: block
            node = self.root
            for label in reversed(rule.host.translate(LOWER).split(".")) if rule.host else ():
                node = node.setdefault("." + label, {})
            node = node.setdefault("/", {})
            *whole, last = re.findall(r"[^/]*/|[^/]+$", rule.path) or [""]
            for segment in whole if not last.endswith("/") else (*whole, last):
                node = node.setdefault(segment, {})
            if last.endswith("/"):
                node[None] = rule
            else:
                node.setdefault("", {})[last] = rule

    @staticmethod
    def _in_path(node: dict, path: str) -> Rule | None:
        best = None
        for segment in [*re.findall(r"[^/]*/|[^/]+$", path), ""]:
            best = node.get(None, best)
            ends = [end for end in node.get("", ()) if segment.startswith(end)]
            if ends:
                best = node[""][max(ends, key=len)]
            node = node.get(segment) if segment else None
            if node is None:
                return best
        return best

    def longest(self, host: str, path: str) -> Rule | None:
        """The rule with most host labels, then with the longest path, that fits."""
        node, best = self.root, None
        labels = reversed(host.split(".")) if host else ()
        for label in (None, *labels):
            node = node if label is None else node.get("." + label)
            if node is None:
                break
            if "/" in node:
                best = self._in_path(node["/"], path) or best
        return best


OUT = "host string, path string, rule string, verdict string"


def _judge(batch: pa.RecordBatch, tries: Trie, default: str, keep: int) -> pa.RecordBatch:
    hosts, paths, rules, verdicts = [], [], [], []
    for url in batch.column("url").to_pylist():
        host, path = parts(url)
        rule = tries.longest(host, path) if host else None
        hosts.append(host)
        paths.append(path)
        rules.append(rule and rule.text)
        verdicts.append(rule.verdict if rule else default)
    kept = [batch.column(i) for i in range(keep)]
    return pa.RecordBatch.from_arrays([*kept, *[pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts)]], names=[*batch.schema.names[:keep], "host", "path", "rule", "verdict"])


def classify(pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = "allow", limit: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every row."""
    rules = list(dict.fromkeys(rules))
    if sum(len(r.text) + len(r.verdict) for r in rules) > limit:
        return by_join(pages, pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string"), default)
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(rules)
    rows = project(pages, "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            yield _judge(batch, trie, default, 2)

    return rows.mapInArrow(tidy(run), f"{rows.schema.simpleString()[7:-1].replace(':', ' ')}, {OUT}")


def by_join(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """As :func:`classify`, for a table of rules (verdict, host, path) too large to broadcast.

    Each url looks up its own host suffixes with each prefix of its path up to a
    slash (a bounded number of keys); rules that end inside a segment are looked
    up by their host and the segments before it. The longest fitting rule wins.
    """
    spark = pages.sparkSession
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    table = rules.groupBy(F.translate("host", upper, lower).alias("r_host"), F.col("path").alias("r_path")).agg(F.max("verdict").alias("r_verdict"), F.max(F.concat("host", "path")).alias("r_text"))
    table = table.withColumn("r_stem", F.regexp_extract("r_path", r"^(.*/)?", 0))
    url = F.coalesce("url", F.lit(""))
    rows = project(pages, "page_id", "url").withColumn("uid", F.struct(F.spark_partition_id(), F.monotonically_increasing_id()))
    rows = rows.withColumn("host", F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower)).withColumn("path", F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    rows = stored(rows, new_folder(spark, "urls"), "rows")
    labels, segments = F.split("host", r"\."), F.regexp_extract_all("path", F.lit(r"[^/]*/"), F.lit(0))
    keys = rows.select("uid", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, -i, i), "."))).alias("r_host"), segments.alias("s"))
    keys = keys.filter("r_host <> ''").select("uid", "path", "r_host", F.explode(F.transform(F.sequence(F.lit(0), F.size("s")), lambda i: F.array_join(F.slice("s", 1, i), ""))).alias("r_stem"))
    fits = keys.join(table, ["r_host", "r_stem"]).filter(F.expr("startswith(path, r_path)"))
    order = F.struct(F.length("r_host"), F.length("r_path"))
    won = fits.groupBy("uid").agg(F.max_by(F.struct("r_text", "r_verdict"), order).alias("won"))
    return rows.join(won, "uid", "left").select("page_id", "url", "host", "path", F.col("won.r_text").alias("rule"), F.coalesce("won.r_verdict", F.lit(default)).alias("verdict"))
