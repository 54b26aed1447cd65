"""Operator 2: URL verdicts by rules, and by naive Bayes over segmented names."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvewright.llm.common import ascii_lower, query, stored, table

#: (verdict, host, path prefix): a rule fits its host and all subdomains.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Words that mark a host as spam for training where no rule fits. The unigram
#: vocabulary holds them whether or not the pages do.
SPAM = (
    "ads", "adult", "bet", "bets", "betting", "casino", "loans", "payday", "pills", "poker", "porn", "slots", "spam",
    "viagra", "xxx",
)
#: What each of these words adds to a host's log odds besides what is learned.
SPAM_PRIOR = 6.0
#: Longest word of a segmentation, in letters.
LONGEST = 20
_URLS = ("__host", "__path")


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one string) and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, name + prefix).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _names(host: Column) -> Column:
    return F.regexp_extract_all(host, F.lit("[a-z]+"), F.lit(0))


def _split(name: str, found: list[tuple[int, int, int]], total: int) -> list[str]:
    """The most probable split of ``name``; ties go to the longer first word.

    ``found`` has (start, length, count) of the known words in it. An unknown
    word of n letters has probability 1 / (total * 10^n).
    """
    n = len(name)
    known = {(s, k): math.log(c / total) for s, k, c in found}
    best, take = [0.0] * (n + 1), [0] * (n + 1)
    for at in range(n - 1, -1, -1):
        best[at] = -math.inf
        for k in range(min(LONGEST, n - at), 0, -1):
            score = known.get((at, k), -math.log(total) - k * math.log(10)) + best[at + k]
            if score > best[at]:
                best[at], take[at] = score, k
    words, at = [], 0
    while at < n:
        words.append(name[at : at + take[at]])
        at += take[at]
    return words


def segmented(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words): the letter runs of all ``__host`` values, split by unigram Viterbi.

    ``words`` (word, n) counts the corpus. Only substrings of names are looked
    up, by a join, so no task ever holds the vocabulary; a name's matches are
    bounded by its own length.
    """
    names = stored(hosts.select(F.explode(_names(F.col("__host"))).alias("name")).distinct(), "names")
    pieces = (
        names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("s"))
        .select("name", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("s")))).alias("k"))
        .withColumn("word", F.substr("name", F.col("s") + 1, F.col("k")))
    )
    spam = hosts.sparkSession.createDataFrame([(w,) for w in SPAM], "word string")
    # Every corpus word once more for the listed ones: they are known, however rare.
    counts = words.join(pieces.select("word").distinct(), "word", "left_semi")
    counts = stored(
        counts.unionByName(spam.select("word", F.lit(1000).cast("long").alias("n"))).groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    total = int(words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) + 1000 * len(SPAM)
    matched = pieces.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("s", "k", "n")).alias("found"))

    def work(batches):
        for batch in batches:
            split = [
                _split(name, [(x["s"], x["k"], x["n"]) for x in found or ()], total)
                for name, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))], names=["name", "words"])

    return stored(names.join(matched, "name", "left").mapInArrow(work, "name string, words array<string>"), "segments")


def page_words(pages: DataFrame) -> DataFrame:
    """(word, n): lower-case letter runs of all pages' visible text."""
    text = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(text), F.lit(rf"\b[a-z]{{1,{LONGEST}}}\b"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _path_tokens(path: Column) -> Column:
    parts = F.regexp_extract_all(ascii_lower(path), F.lit("[a-z]+|[0-9]+"), F.lit(0))
    return F.transform(parts, lambda x: F.concat(F.lit("p:"), F.when(x.rlike("^[0-9]"), "#").otherwise(x)))


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html) with its verdict.

    A rule decides where one fits. Elsewhere a multinomial naive Bayes scores
    the words of the host's names and of the path; it learns from what the rules
    decide, from hosts with a word of ``SPAM`` as blocked, and from all other
    URLs as allowed, which most of them are. Score above zero blocks, zero
    (also: nothing to learn from) allows. Null and odd URLs have an
    empty host and path and are scored by the priors; repeated rows are all
    returned; an empty table gives an empty result; other columns are not read.

    URLs are judged once per (host, path) and names once per name, so a common
    host is a skewed join key, never a group in one task; counts combine before
    they move.
    """
    host, path = parsed(F.col("url"))
    rule, verdict = ruled(F.col("__host"), F.col("__path"), rules)
    urls = stored(pages.select(host.alias("__host"), path.alias("__path")).distinct(), "urls")
    hosts = stored(urls.select("__host").distinct(), "hosts")
    segments = segmented(hosts, stored(page_words(pages), "page-words"))
    host_tokens = (
        hosts.select("__host", F.posexplode(_names(F.col("__host"))).alias("at", "name"))
        .join(segments, "name")
        .groupBy("__host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
        .select("__host", F.flatten("parts.words").alias("words"))
    )
    tokens = stored(
        urls.join(stored(host_tokens, "host-words"), "__host", "left")
        .withColumn("__verdict", verdict)
        .select(
            *_URLS,
            F.coalesce("words", F.array().cast("array<string>")).alias("words"),
            F.coalesce(
                "__verdict",
                F.when(F.arrays_overlap("words", F.array(*map(F.lit, SPAM))), "block"),
                F.lit("allow"),
            ).alias("label"),
        )
        .withColumn(
            "tokens", F.concat(F.transform("words", lambda w: F.concat(F.lit("h:"), w)), _path_tokens(F.col("__path")))
        ),
        "tokens",
    )
    block = F.col("label") == "block"
    learned = tokens.select(block.cast("long").alias("b"), F.explode("tokens").alias("token"))
    counts = stored(
        learned.groupBy("token").agg(F.sum("b").alias("b"), F.sum(1 - F.col("b")).alias("a")), "token-counts"
    )
    b, a, v = counts.agg(F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0)), F.count(F.lit(1))).first()
    prior = tokens.agg(F.count_if(block).alias("b"), F.count_if(~block).alias("a")).first()
    model = stored(
        counts.select(
            "token",
            (F.log((F.col("b") + 1) / F.lit(float(b + v + 1))) - F.log((F.col("a") + 1) / F.lit(float(a + v + 1)))
             + F.when(F.col("token").isin(*["h:" + w for w in SPAM]), SPAM_PRIOR).otherwise(0.0)).alias("w"),
        ),
        "token-weights",
    )
    scores = (
        tokens.select(*_URLS, F.explode("tokens").alias("token"))
        .join(model, "token")
        .groupBy(*_URLS)
        .agg(F.sum("w").alias("w"))
    )
    start = math.log((prior["b"] + 1) / (prior["a"] + 1))
    judged = stored(
        tokens.join(scores, list(_URLS), "left").select(
            *_URLS, "words", (F.coalesce("w", F.lit(0.0)) + F.lit(start)).alias("score")
        ),
        "judged",
    )
    return (
        pages.select("page_id", host.alias("__host"), path.alias("__path"))
        .join(judged, list(_URLS))
        .select(
            "page_id",
            F.col("__host").alias("host"),
            F.col("__path").alias("path"),
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
            F.col("words").alias("host_words"),
            "score",
        )
    )


@query("op2_urls")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL."""
    return verdicts(table(spark, sf_dir, "pages"))
