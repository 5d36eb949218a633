"""URL filters by a temporal list join.

List entries are dated: a host or a path prefix is added to a list, or removed from it, at a time.
Entries of one rule become intervals during which it is listed, and every capture of a URL is
evaluated against the entries that were active when it was fetched: its host, the domains above it and
its path prefixes are looked up, each as of the fetch time. A capture is blocked if the longest active
rule that matches it is on a block list; where an allow list has a rule of that length, allow wins.

Equal captures are evaluated once. Lookup is a join on the rule's text. Nearly every URL asks for its
top-level domain, so rules are counted first; one that more captures ask for than a ten-thousandth of
all is split into salts by capture, and its few intervals go to each. No group is gathered.

Cases: a NULL or unparsable URL, or a NULL fetch time, matches nothing; entries with a NULL field, or
with another action, kind or effect than those below, are ignored; of entries of one rule at one time
a removal wins; a repeated add or removal changes nothing; an entry is active from its own time on;
repeated captures are evaluated alike, and other columns are kept, whatever their names, but for
columns named like a result, which give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm import storage

#: Rules that may count as hot, and captures that always fit one salt.
HOT_RULES, HOT_ROWS = 10_000, 1024
RESULTS = ("blocked", "rule", "lists")
ADD, REMOVE = "add", "remove"
HOST, PREFIX = "host", "prefix"
BLOCK, ALLOW = "block", "allow"
_HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^:/?#@]+)"
_PATH = r"^[^:/?#]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without port and final dot; empty if there is none."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), _HOST, 1), r"\.$", "")


def rules_of(url: Column) -> Column:
    """All rules that may match a URL: its host and the domains above it, and its path prefixes by segment."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit(HOST).alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")))
    parts = F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda p: p != "")
    steps = F.filter(F.sequence(F.lit(0), F.size(parts)), lambda i: i > 0)
    prefixes = F.transform(steps, lambda i: F.struct(F.lit(PREFIX).alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("value")))
    return F.when(host != "", F.array_distinct(F.concat(hosts, prefixes)))


def listed_intervals(entries: DataFrame) -> DataFrame:
    """(list, effect, kind, value, since, until) from dated entries (list, effect, kind, value, at, action); ``until`` is NULL while listed."""
    rule = ("list", "effect", "kind", "value")
    sound = F.col("kind").isin(HOST, PREFIX) & F.col("effect").isin(BLOCK, ALLOW) & F.col("action").isin(ADD, REMOVE)
    complete = F.col("list").isNotNull() & F.col("value").isNotNull() & F.col("at").isNotNull()
    # 'remove' is the greater action, so it wins at one time
    dated = entries.where(sound & complete).groupBy(*rule, "at").agg(F.max("action").alias("action"))
    by_rule = Window.partitionBy(*rule).orderBy("at")
    changes = dated.withColumn("before", F.lag("action", 1, REMOVE).over(by_rule)).where(F.col("action") != F.col("before"))
    spans = changes.withColumn("until", F.lead("at").over(by_rule)).where(F.col("action") == ADD)
    return spans.select(*rule, F.col("at").alias("since"), "until")


def _salted(asked: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the lookup with a salt; only rules that many captures ask for have more than one."""
    counts = storage.written(asked.groupBy("kind", "value").agg(F.count("*").alias("n")), "asked-rules")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_RULES)
    # fewer than HOT_RULES rules, whatever the size
    hot = F.broadcast(counts.where(F.col("n") > most).select("kind", "value", F.ceil(F.col("n") / most).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    dealt = asked.join(hot, ["kind", "value"], "left").withColumn("salt", F.pmod(F.xxhash64("url", "at"), salts).cast("int")).drop("salts")
    copies = spans.join(hot, ["kind", "value"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return dealt, copies


def evaluated(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with blocked, rule (the longest active one) and lists (all that have an active match)."""
    if {url, at} & set(RESULTS):
        raise ValueError(f"{url!r} and {at!r} can't be columns of the result")
    captures = captures.drop(*RESULTS)
    fetched = captures.select(F.col(url).alias("url"), F.col(at).alias("at")).where(F.col("url").isNotNull() & F.col("at").isNotNull()).distinct()
    asked = fetched.select("url", "at", F.explode(rules_of(F.col("url"))).alias("rule")).select("url", "at", "rule.kind", "rule.value")
    asked, spans = _salted(asked, listed_intervals(entries))
    active = (F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))
    matches = asked.join(spans, ["kind", "value", "salt"]).where(active)
    best = F.struct(F.length("value").alias("length"), (F.col("effect") == ALLOW).alias("allow"), F.col("value").alias("rule"))
    names = [storage.free_name(captures, n) for n in ("verdict_url", "verdict_at", "verdict_best", "verdict_lists")]
    of_url, of_at, top, found = names
    verdict = matches.groupBy(F.col("url").alias(of_url), F.col("at").alias(of_at)).agg(F.max(best).alias(top), F.sort_array(F.collect_set("list")).alias(found))
    joined = captures.join(verdict, (F.col(url) == F.col(of_url)) & (F.col(at) == F.col(of_at)), "left")
    return joined.select(
        *captures.columns,
        F.coalesce(~F.col(f"{top}.allow"), F.lit(False)).alias("blocked"),
        F.col(f"{top}.rule").alias("rule"),
        F.coalesce(found, F.array().cast("array<string>")).alias("lists"),
    )
