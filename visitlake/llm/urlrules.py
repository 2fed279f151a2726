"""URL rules fetched by their rarest literal token.

A rule is a pattern over ``host + path``: ``||`` in front stands for the start of a host
label, ``^`` for a place where no letter or digit goes on, ``*`` for anything; the rest is
literal. Every whole token a pattern spells out must be a token of each URL it fits, so the
rule is filed under the one of them that the fewest URLs hold. A URL's tokens then fetch
candidate rules by a join, and only those run their regular expression. Rules without a
whole token are filed under the empty token, which every URL holds.

DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.llm.common import narrow, stored

ALLOW, BLOCK = "allow", "block"
#: Beyond this many bytes of patterns the index is joined by a shuffle instead of sent to every task.
BROADCAST_BYTES = 4_000_000
RULE = "rule string, pattern string, tier int, verdict string, regex string, tokens array<string>, length int"


def host_rule(rule: str, verdict: str) -> tuple[str, str, int, str]:
    """``example.org/es/``: a host with all its subdomains, and a beginning of the path."""
    return rule, f"||{rule}", 0, verdict


def to_regex(pattern: str) -> str:
    """The pattern as a regular expression that both Java and Python read alike."""
    head, body = "", pattern
    if body.startswith("||"):
        head, body = r"\A(?:[^/]*\.)?", body[2:]
    elif body.startswith("^"):
        head, body = "(?<![A-Za-z0-9])", body[1:]
    tail = ""
    if body.endswith("^"):
        body, tail = body[:-1], "(?![A-Za-z0-9])"
    parts = {"*": r"[\s\S]*", "^": "[^A-Za-z0-9]"}
    return head + "".join(parts.get(c) or re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", c) for c in body) + tail


def whole_tokens(pattern: str) -> list[str]:
    """Tokens that any fitting URL holds whole: bounded on both sides by something literal."""
    anchored = re.sub(r"^\|\|", "^", pattern)
    found = re.finditer(r"[A-Za-z0-9]+", anchored)
    return sorted({m.group().lower() for m in found
                   if m.start() and anchored[m.start() - 1] != "*" and m.end() < len(anchored) and anchored[m.end()] != "*"})


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, int, str]]) -> DataFrame:
    """Rules as ``(rule, pattern, tier, verdict)``: a lower tier outranks, then the longer pattern."""
    rows = [(rule, pattern, tier, verdict, to_regex(pattern), whole_tokens(pattern), len(re.sub(r"^\|\||\*|\^", "", pattern)))
            for rule, pattern, tier, verdict in rules]
    return spark.createDataFrame(rows, RULE)


def lowered(text: Column) -> Column:
    """A-Z only: other letters are no part of a token, in whatever case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` with A-Z lowered, and from there to ``?`` or ``#``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({'__url'}, instr({'__url'}, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return lowered(host), path


def keyed(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_and_path(F.col("__url"))
    rows = pages.withColumn("__url", url).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    # Splitting leaves an empty token in front of a separator; it is wanted in any case.
    return rows.withColumn("tokens", F.array_distinct(F.concat(F.array(F.lit("")), F.split(lowered(F.col("key")), "[^a-z0-9]+"))))


def sized(index: DataFrame) -> DataFrame:
    """The index, to be sent to every task if it is small enough for that."""
    size = index.agg(F.sum(F.length("regex") + F.length("rule") + 64)).first()[0] or 0
    return F.broadcast(index) if size <= BROADCAST_BYTES else index


def filed(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule under the token of its that the fewest URLs hold (ties: the first one)."""
    spelled = rules.select(F.col("pattern").alias("p"), F.explode("tokens").alias("token")).distinct()
    spelled_out = sized(rules.select(F.explode("tokens").alias("token"), "regex", "rule").dropDuplicates(["token"]))
    held = (rows.select(F.explode("tokens").alias("token")).join(spelled_out.select("token"), "token")
            .groupBy("token").agg(F.count("*").alias("n")))
    rarest = (spelled.join(held, "token", "left").groupBy("p")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
              .select(F.col("p").alias("pattern"), F.col("best.token").alias("token")))
    return rules.join(rarest, "pattern", "left").withColumn("token", F.coalesce("token", F.lit("")))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, tier, verdict`` for every row.

    The fitting rule of the lowest tier wins, then the longest, then the first by name; where
    none fits, ``rule`` and ``tier`` are null and the verdict is ``default``. A null URL, or
    one without ``://``, has an empty host and path. Repeated rows are repeated.
    """
    rows = keyed(narrow(pages, page_id=page_id, url=url))
    index = sized(stored(filed(rows, rules).select("token", "rule", "regex", "tier", "verdict", "length")))
    best = F.min(F.struct("tier", (-F.col("length")).alias("length"), "rule", "verdict")).alias("best")
    fits = (rows.select("page_id", "url", "key", F.explode("tokens").alias("token")).join(index, "token")
            .filter(F.expr("key RLIKE regex")).groupBy("page_id", "url").agg(best))
    fits = fits.select(F.col("page_id").alias("__id"), F.col("url").alias("__url"), "best")
    same = F.col("page_id").eqNullSafe(F.col("__id")) & F.col("url").eqNullSafe(F.col("__url"))
    return rows.join(fits, same, "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.tier").alias("tier"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


#: The rules the query is given, and patterns of its own for URLs none of them fits.
GIVEN = [host_rule("org/", ALLOW), host_rule("example.org/es/", BLOCK), host_rule("example.org/en/1", BLOCK),
         host_rule("com/fr/", ALLOW), host_rule("com/de/", BLOCK)]
UNWANTED = ("casino", "casinos", "poker", "bets", "betting", "jackpot", "pills", "viagra", "porn", "xxx", "escort", "payday")
OWN = [(word, f"^{word}^", 1, BLOCK) for word in UNWANTED]
