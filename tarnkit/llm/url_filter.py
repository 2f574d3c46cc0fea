"""URL verdicts by rules on hosts and paths, and by a classifier of segmented host and path words elsewhere."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.llm.components import stored
from tarnkit.llm.html_extract import host_of
from tarnkit.llm.keyfilter import key_bits, with_maybe
from tarnkit.operators.lookups import fits_broadcast

LONGEST_WORD = 24
#: Words of hosts that no corpus of prose need hold: they count as often as this share of all words.
LEXICON_SHARE = 1e-5
#: A smaller corpus counts as one of so many words, or single letters would pass for words.
LEAST_TOTAL = 1_000_000

#: Hosts with one of these words are examples of what to block where no rule decides (a parameter, not a verdict).
BLOCK_SEEDS = tuple(
    "adult ads bet bets betting casino escort gambling jackpot lottery malware nude payday phishing pharmacy pills poker porn slots spam "
    "viagra warez xxx".split()
)
#: Other words that are common in host names.
HOST_WORDS = tuple(
    "app best blog buy cdn cheap club com edu fast forum free farm game games gov info live mail media mobile net news "
    "online org shop site sport store track tracker travel web win wiki world www".split()
)


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``rules`` (``host/path``, verdict) that fits, and its verdict; null without one.

    A rule fits its host and all subdomains, if the path starts with the rule's. Of equally long rules the first by name counts.
    """
    rule = verdict = F.lit(None).cast("string")
    for name, decision in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        at = name.index("/")
        suffix, start = name[:at], name[at:]
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def path_kind(path: Column) -> Column:
    """A path in lower case with each number as one #: paths of a kind have the same words."""
    return F.regexp_replace(F.lower(path), "[0-9]+", "#")


def path_words(kind: Column) -> Column:
    return F.filter(F.split(kind, r"[^\p{L}#]+"), lambda w: w != "")


def corpus_counts(texts: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """How often each word of ``wanted`` (word) stands in the column of ``texts``, and how many words there are.

    Every text is read whole. A bounded filter passes only words that may be wanted, so few words are shuffled, added up before.
    """
    text = F.col(f"`{texts.columns[0]}`").cast("string")
    words = texts.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word")).filter("word != ''")
    flagged = with_maybe(words, F.xxhash64("word"), key_bits(wanted, F.xxhash64("word")), "maybe")
    counts = stored(
        flagged.groupBy(F.when(F.col("maybe"), F.col("word")).alias("word")).agg(F.count(F.lit(1)).alias("n")), "words"
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    return wanted.join(counts, "word"), total


def segment(names: DataFrame, texts: DataFrame, lexicon: Sequence[str]) -> DataFrame:
    """name, words for distinct ``names`` (name: letters a to z): the split into words with the highest product of unigram
    probabilities, by Viterbi's algorithm.

    Probabilities are shares in the corpus ``texts``; words of ``lexicon`` have LEXICON_SHARE at least, and an unknown
    word of length n 10 / (total * 10^n). A name's possible words are joined with their counts, so no word list is sent around;
    a word has at most LONGEST_WORD letters, longer unknown ones are pieced together.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1)))
    pieces = names.select("name", F.explode(starts).alias("at")).select(
        "name", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("at") + 1))).alias("n"), "at"
    )
    pieces = stored(pieces.select("name", F.substring("name", F.col("at"), F.col("n")).alias("word")).distinct(), "pieces")
    counts, total = corpus_counts(texts, pieces.select("word").distinct())
    total = max(total, LEAST_TOTAL)
    listed = F.array(*map(F.lit, sorted(set(lexicon)))) if lexicon else F.array().cast("array<string>")
    known = pieces.join(counts, "word", "left").withColumn(
        "n", F.when(F.array_contains(listed, F.col("word")), F.greatest(F.coalesce("n", F.lit(0)), F.lit(LEXICON_SHARE * total))).otherwise(F.col("n"))
    )
    found = known.filter("n > 0").select("name", F.struct("word", F.col("n").cast("double").alias("n")).alias("w"))
    maps = names.join(found, "name", "left").groupBy("name").agg(F.map_from_entries(F.collect_list("w")).alias("counts"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(name: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([best_split(n, dict(c), total) for n, c in zip(name, counts)], dtype=object)

    return maps.select("name", split("name", "counts").alias("words"))


def best_split(name: str, counts: dict[str, float], total: int) -> list[str]:
    """Of equally likely splits the one with the longer last word, and so on towards the front."""
    unknown = [math.log(10 / total) - n * math.log(10) for n in range(LONGEST_WORD + 1)]
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        score, at = -math.inf, end - 1
        for start in range(max(0, end - LONGEST_WORD), end):
            n = counts.get(name[start:end])
            value = best[start] + (math.log(n / total) if n else unknown[end - start])
            if value > score:
                score, at = value, start
        best.append(score)
        cut.append(at)
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def classify_urls(
    urls: DataFrame, texts: DataFrame, seeds: Sequence[str] = BLOCK_SEEDS, lexicon: Sequence[str] = HOST_WORDS
) -> DataFrame:
    """host, kind, block, log_odds for the kinds of URLs in ``urls`` (host, path, and ``decision``, block or allow, where one is known; the column may be left out).

    Host names are cut at all but letters and segmented (:func:`segment`). URLs with a decision are examples of it; of the others those on hosts with one of the words
    ``seeds`` are examples to block, the rest examples to allow; multinomial naive Bayes with add-one smoothing learns the words of hosts and paths
    from all URLs and scores every kind: block is whether blocking is likelier. URLs with one host and path kind are counted
    together first, so a host with very many pages is one row from then on. Without a URL of either class the score is that of smoothing alone.
    """
    decision = F.col("decision") if "decision" in urls.columns else F.lit(None).cast("string")
    counts = {"n": F.count(F.lit(1)), "n_block": F.count_if(decision == "block"), "n_allow": F.count_if(decision == "allow")}
    kinds = urls.groupBy("host", path_kind(F.col("path")).alias("kind")).agg(*[c.alias(name) for name, c in counts.items()])
    kinds = stored(kinds, "kinds")
    hosts = kinds.select("host").distinct()
    parts = hosts.select("host", F.explode(F.regexp_extract_all("host", F.lit("([a-z]+)"), F.lit(1))).alias("name"))
    words = segment(parts.select("name").distinct(), texts, [*seeds, *lexicon])
    of_host = parts.join(words, "name").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("host_words"))
    known = stored(hosts.join(of_host, "host", "left"), "host-words")
    none = F.array().cast("array<string>")
    host_words = F.coalesce("host_words", none)
    seed = F.arrays_overlap(host_words, F.array(*map(F.lit, seeds)))
    tokens = F.concat(F.transform(host_words, lambda w: F.concat(F.lit("h:"), w)), F.transform(path_words(F.col("kind")), lambda w: F.concat(F.lit("p:"), w)))
    block = F.col("n_block") + seed.cast("int") * (F.col("n") - F.col("n_block") - F.col("n_allow"))
    examples = kinds.join(known, "host").select("host", "kind", block.alias("n_block"), (F.col("n") - block).alias("n_allow"), tokens.alias("tokens"))
    examples = stored(examples, "examples")
    by_token = examples.select("n_block", "n_allow", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("n_block").alias("n_block"), F.sum("n_allow").alias("n_allow")
    )
    by_token = stored(by_token, "token-counts")
    size = by_token.agg(F.count(F.lit(1)), F.sum("n_block"), F.sum("n_allow")).first()
    vocabulary, all_block, all_allow = size[0], size[1] or 0, size[2] or 0
    pages = examples.agg(F.sum("n_block"), F.sum("n_allow")).first()
    prior = math.log(((pages[0] or 0) + 1) / ((pages[1] or 0) + 1))
    shift = math.log((all_allow + vocabulary + 1) / (all_block + vocabulary + 1))
    weights = by_token.select("token", (F.log(F.col("n_block") + 1) - F.log(F.col("n_allow") + 1) + shift).alias("weight"))
    scored = (
        examples.select("host", "kind", F.explode("tokens").alias("token")).join(weights, "token")
        .groupBy("host", "kind").agg(F.round(F.sum("weight"), 9).alias("evidence"))
    )
    odds = F.coalesce("evidence", F.lit(0.0)) + prior
    return examples.select("host", "kind").join(scored, ["host", "kind"], "left").select(
        "host", "kind", odds.alias("log_odds"), (odds > 0).alias("block")
    )


def filter_urls(
    pages: DataFrame,
    texts: DataFrame,
    rules: Sequence[tuple[str, str]],
    url: str = "url",
    seeds: Sequence[str] = BLOCK_SEEDS,
    lexicon: Sequence[str] = HOST_WORDS,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block) and log_odds of blocking.

    The longest fitting rule decides (:func:`rule_of`), without one the classifier (:func:`classify_urls`), which learns from what the rules decided too, with word counts from all of
    ``texts`` (its first column). Null urls and those without ``://`` have an empty host and path, no rule and the verdict of their kind,
    which has no words and so follows the prior. Repeated rows are kept; columns of these names in the input are replaced.
    """
    address = F.col(f"`{url}`")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "log_odds")]
    rows = pages.select(*kept, host_of(address).alias("host"), path_of(address).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    kinds = stored(classify_urls(rows.select("host", "path", verdict.alias("decision")), texts, seeds, lexicon), "url-kinds")
    kinds = F.broadcast(kinds) if fits_broadcast(kinds) else kinds
    found = rows.withColumn("kind", path_kind(F.col("path"))).join(kinds, ["host", "kind"], "left")
    learnt = F.when(F.coalesce("block", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return found.select(*kept, "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "log_odds")
