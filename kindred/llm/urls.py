"""URL filters: host word segmentation and multinomial naive Bayes.

Rules decide what they fit; they also label the pages from which a naive Bayes model learns to judge
the rest. Host names are concatenated words: a unigram model of the words in all pages splits them
by Viterbi search. Only distinct runs of letters are split, and each fetches the counts of its own
substrings by a join, so the word table never has to fit anywhere.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import UPPER, text_of
from kindred.session import through_table

LONGEST = 20  # letters of a word
SALTS = 16


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def split_url(url: str) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    text = text_of(url)
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower(host), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones the first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(str(r))):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, str(rule)).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def viterbi(run: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a run of letters; an unknown word costs by its length."""
    best, cut = [0.0] + [-math.inf] * len(run), [0] * (len(run) + 1)
    log_total = math.log(total + 1)
    for end in range(1, len(run) + 1):
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(run[start:end], 0)
            cost = math.log(n) if n else -math.log(10) * (end - start)
            score = best[start] + cost - log_total
            if score > best[end]:
                best[end], cut[end] = score, start
    words, end = [], len(run)
    while end:
        words.append(run[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segment(runs: DataFrame, words: DataFrame) -> DataFrame:
    """``run`` and its ``words`` for distinct runs of letters; ``words``: ``word`` and ``n``."""
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = runs.select(
        "run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start")
    ).select(
        "run",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("run") - F.col("start") + 1)),
                lambda n: F.substr("run", F.col("start"), n),
            )
        ).alias("word"),
    ).distinct()
    known = (
        parts.join(words, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    )

    def split(batches):
        for batch in batches:
            runs_ = batch.column("run").to_pylist()
            known_ = batch.column("known").to_pylist()
            out = [viterbi(r, {k["word"]: k["n"] for k in ks or ()}, total) for r, ks in zip(runs_, known_)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("run"), pa.array(out, pa.list_(pa.string()))], ["run", "words"]
            )

    return runs.join(known, "run", "left").mapInArrow(split, "run string, words array<string>")


def word_counts(pages: DataFrame, text_col: str) -> DataFrame:
    """Words of up to 20 letters a-z in whole texts, without markup, and how often they occur."""
    bare = F.regexp_replace(lower(text_of(text_col)), r"<[^<>]*>", " ")
    words = F.regexp_extract_all(bare, F.lit(rf"(?<![a-z])[a-z]{{2,{LONGEST}}}(?![a-z])"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and
    ``log_odds`` (of block, null where a rule decides).

    The longest rule that fits decides, otherwise naive Bayes with add-one counts over host words and
    path words (in lower case): block where the odds are above one. Null urls have empty hosts and paths and are
    judged by the odds of the two classes, as are all pages where no rule fits any. Repeated pages
    are learnt from and judged each. Other columns are not looked at.
    """
    host, path = split_url(url_col)
    parsed = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")
    )
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = through_table(parsed.withColumns({"rule": text, "verdict": verdict}), "pages")
    found = lambda c, letters: F.regexp_extract_all(c, F.lit(rf"{letters}+|[0-9]+"), F.lit(0))
    hosts = parsed.select("host").distinct().select("host", F.explode(found(F.col("host"), "[a-z]")).alias("run"))
    hosts = through_table(hosts, "hosts")
    runs = hosts.where("run >= 'a'").select("run").distinct()
    words = through_table(word_counts(pages, text_col), "words")
    split = segment(runs, words)
    # A number counts by its digits, wherever it stands.
    digits = lambda c: F.when(c < "a", F.concat(F.lit("#"), F.length(c).cast("string"))).otherwise(c)
    host_words = (
        hosts.join(split, "run", "left")
        .select("host", F.explode(F.coalesce("words", F.array("run"))).alias("word"))
        .select("host", F.concat(F.lit("h:"), digits(F.col("word"))).alias("token"))
    )
    host_words = through_table(
        host_words.groupBy("host", "token").agg(F.count(F.lit(1)).alias("n")), "hostwords"
    )
    path_words = parsed.select("row", "verdict", F.explode(found(F.lower("path"), r"\p{L}")).alias("word")).select(
        "row", "verdict", F.concat(F.lit("p:"), digits(F.col("word"))).alias("token"), F.lit(1).cast("long").alias("n")
    )
    decided = parsed.where("verdict is not null")
    by_host = decided.groupBy("host", "verdict").agg(F.count(F.lit(1)).alias("pages"))
    seen = (
        by_host.join(host_words, "host")
        .select("token", "verdict", (F.col("pages") * F.col("n")).alias("n"))
        .unionByName(path_words.where("verdict is not null").select("token", "verdict", "n"))
    )
    blocked = F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)
    counts = through_table(
        seen.groupBy("token").agg(F.sum(blocked).alias("block"), F.sum(F.col("n") - blocked).alias("allow")),
        "tokens",
    )
    n_tokens, block, allow = (x or 0 for x in counts.agg(F.count("token"), F.sum("block"), F.sum("allow")).first())
    n_block, n_allow = decided.agg(
        F.count_if(F.col("verdict") == "block"), F.count_if(F.col("verdict") != "block")
    ).first()
    prior = math.log((n_block + 1) / (n_allow + 1))
    unknown = math.log((allow + n_tokens + 1) / (block + n_tokens + 1))
    odds = F.log((F.col("block") + 1) / (F.col("allow") + 1)) + unknown
    weights = counts.select("token", odds.alias("odds"))
    # Odds of hosts once per host; frequent path words are spread over salted copies of the weights.
    host_odds = (
        host_words.join(weights, "token", "left")
        .groupBy("host")
        .agg(F.sum(F.col("n") * F.coalesce("odds", F.lit(unknown))).alias("host_odds"))
    )
    salted = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    path_odds = (
        path_words.where("verdict is null")
        .withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
        .join(salted, ["token", "salt"], "left")
        .groupBy("row")
        .agg(F.sum(F.coalesce("odds", F.lit(unknown))).alias("path_odds"))
    )
    # The pages of a frequent host, too, are spread over copies of its odds.
    salted_hosts = host_odds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = (
        parsed.where("verdict is null")
        .withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
        .join(salted_hosts, ["host", "salt"], "left")
        .join(path_odds, "row", "left")
        .withColumn(
            "log_odds",
            F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)),
        )
        .withColumn("verdict", F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
    )
    out = ["page_id", "host", "path", "rule", "verdict", "log_odds"]
    return (
        parsed.where("verdict is not null")
        .withColumn("log_odds", F.lit(None).cast("double"))
        .select(*out)
        .unionByName(rest.select(*out))
    )
