"""URL verdicts: rules by host and path first, then a ratio of character language models.

DataFrame functions only. URLs that a rule allows and URLs that a rule blocks are the
examples of two models: Markov models of variable order, whose contexts are the up to
``ORDER`` characters before the next one. A context gives a character the count it had
there, smoothed by the same character's probability in the context that is one shorter
(Witten and Bell), down to equal shares of the alphabet; a context that was never seen
hands on to the shorter one unchanged. A URL's score is the difference of the two
log-likelihoods over its length, and its threshold is where held-out examples of both
kinds are told apart best.

The models are one table of strings of ``ORDER`` + 1 characters with their difference in
millionths, a whole number, so sums do not depend on their order. It grows with the
input. URLs look their strings up by a join: a table that is seen to be small is
broadcast; of a large one only the strings that are frequent, which cannot be many.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waypost.workspace import fits_broadcast, release, settle

#: Longest context, in characters.
ORDER = 4

#: One in this many examples, by their hash, is held out of the models for the threshold.
FOLDS = 5

#: Difference that is 1 in the table, in nats; and the steps of the threshold.
UNIT = 1e-6
STEP = 1_000

#: Most strings that are broadcast of a table too large to be broadcast whole.
HOT_STRINGS = 10_000

#: What stands before a URL's first character, and after its last.
_BEFORE, _AFTER = "\x02", "\x03"

_LONG = "decimal(20,0)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) and the ``rule`` that fits each best, null if none does.

    ``rules`` has ``host``, ``path`` and ``verdict``; those with a null are left out. A rule fits its host and the hosts
    that end with a dot and it, where the path starts with its path; of these the longest
    counts, of equally long ones that with the longer host. ``rule`` is a struct of
    ``text`` (host and path) and ``verdict``.
    """
    rules = rules.select("host", "path", "verdict").dropna()
    by_host = settle(
        rules.distinct().groupBy("host").agg(
            F.collect_list(F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("deep"), "path", "verdict")).alias("rules")
        ).withColumn("labels", F.size(F.split("host", r"\.", -1))),
        "rules",
    )
    small = fits_broadcast(rules)
    fits = lambda r: F.startswith(F.col("path"), r["path"])
    found = []
    for (labels,) in by_host.select("labels").distinct().orderBy("labels").collect():  # a few depths
        side = by_host.filter(F.col("labels") == labels).select(F.col("host").alias("_end"), F.col("rules").alias(f"_rules{labels}"))
        end = F.when(F.size(F.split("host", r"\.", labels)) == labels, F.substring_index("host", ".", -labels))
        urls = urls.withColumn("_end", end).join(F.broadcast(side) if small else side, "_end", "left").drop("_end")
        found.append(f"_rules{labels}")
    if not found:
        return urls.withColumn("rule", F.lit(None).cast("struct<text:string,verdict:string>"))
    fitting = F.flatten(F.array(*(F.filter(F.coalesce(F.col(f), F.array().cast(by_host.schema["rules"].dataType)), fits) for f in found)))
    best = F.array_max(fitting)
    text = F.concat(F.right("host", best["deep"]), best["path"])
    rule = F.when(best.isNotNull(), F.struct(text.alias("text"), best["verdict"].alias("verdict")))
    return urls.withColumn("rule", rule).drop(*found)


def _with_strings(urls: DataFrame, order: int) -> DataFrame:
    """``gram``: each character of a URL, and the end, with the ``order`` characters before it.

    The array of characters is a column of its own: within the lambda it would be made
    anew for each place.
    """
    chars = F.concat(
        F.array(*[F.lit(_BEFORE)] * order), F.filter(F.split("url", ""), lambda c: c != ""), F.array(F.lit(_AFTER))
    )
    grams = F.transform(
        F.sequence(F.lit(0), F.size("_chars") - order - 1),
        lambda i: F.concat(*(F.get("_chars", i + k) for k in range(order + 1))),
    )
    return urls.withColumn("_chars", chars).withColumn("gram", F.explode(grams)).drop("_chars", "url")


def train(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram``, how often it occurs (``n``) and its ``weight``: the difference of its log-probabilities.

    ``urls`` has ``url`` and ``example``: ``allow`` or ``block`` for what is learnt from.
    All strings of all its URLs are in the table, learnt or not, with the weight that the
    models give them.
    """
    one = lambda kind: F.count_if(F.col("example") == kind).alias(kind)
    top = (
        _with_strings(urls.select("url", "example"), order)
        .groupBy("gram")
        .agg(F.count("*").alias("n"), one("allow"), one("block"))
    )
    levels = [settle(top, "url-strings")]
    for _ in range(order):
        shorter = levels[-1].groupBy(F.substring("gram", 2, order + 1).alias("gram"))
        levels.append(settle(shorter.agg(*(F.sum(c).alias(c) for c in ("n", "allow", "block"))), "url-strings"))
    alphabet = levels[-1].count()  # different characters, no more than there are code points
    chance = None
    for size, level in enumerate(reversed(levels)):
        # The strings of a context are no more than the alphabet.
        context = Window.partitionBy(F.substring("gram", 1, size)) if size else Window.partitionBy(F.lit(0))
        if chance is None:
            level = level.withColumns({f"{kind}_chance": F.lit(1.0) / F.lit(max(alphabet, 1)) for kind in ("allow", "block")})
        else:
            level = level.withColumn("_end", F.substring("gram", 2, size + 1)).join(chance, "_end").drop("_end")
        seen = {}
        for kind in ("allow", "block"):
            total, kinds = F.sum(kind).over(context), F.count_if(F.col(kind) > 0).over(context)
            smooth = (F.col(kind) + kinds * F.col(f"{kind}_chance")) / (total + kinds)
            seen[f"{kind}_chance"] = F.when(total > 0, smooth).otherwise(F.col(f"{kind}_chance"))
        level = level.select("gram", "n", *(c.alias(name) for name, c in seen.items()))
        chance = level.select(F.col("gram").alias("_end"), *seen)
    weight = F.round((F.ln("allow_chance") - F.ln("block_chance")) / UNIT).cast("bigint")
    model = settle(level.select("gram", "n", weight.alias("weight")), "url-model")
    for level in levels:
        release(level)
    return model


def score(urls: DataFrame, model: DataFrame, order: int = ORDER, **limits) -> DataFrame:
    """``row``, ``total`` weight and ``length`` (characters and the end) of each of ``urls`` (``row``, ``url``).

    ``limits`` are those of ``fits_broadcast`` for the model.
    """
    rows = _with_strings(urls.select("row", "url"), order)
    if fits_broadcast(model, **limits):
        found = rows.join(F.broadcast(model.select("gram", "weight")), "gram")
    else:
        # No more than HOT_STRINGS strings can each be that share of all.
        share = F.lit(model.agg(F.sum("n")).first()[0] / HOT_STRINGS)
        hot = model.filter(F.col("n") > share).select("gram", F.col("weight").alias("hot"))
        placed = rows.join(F.broadcast(hot), "gram", "left")
        cold = placed.filter("hot IS NULL").join(model.filter(F.col("n") <= share).select("gram", "weight"), "gram")
        found = placed.filter("hot IS NOT NULL").select("row", F.col("hot").alias("weight")).union(cold.select("row", "weight"))
    return found.groupBy("row").agg(F.sum("weight").alias("total"), F.count("*").alias("length"))


def calibrate(scored: DataFrame) -> int:
    """The threshold for ``mean`` that tells held-out examples apart best.

    ``scored`` has ``mean`` and ``example``. The shares of allowed examples at or above it
    and of blocked ones below it have the largest sum. It lies in the middle of the gap
    between two steps that have examples; of equally good ones it is the one nearest to 0,
    then the larger. Without held-out examples of both kinds it is 0.
    """
    one = lambda kind: F.count_if(F.col("example") == kind).alias(kind)
    at = F.floor(F.col("mean") / STEP)
    bins = scored.filter("example IS NOT NULL").groupBy(at.alias("bin")).agg(one("allow"), one("block"))
    # Weights are differences of bounded logarithms, so there are some ten thousand bins at most.
    bins = settle(bins, "score-bins")
    allow, block = bins.agg(F.sum("allow"), F.sum("block")).first()
    if not allow or not block:
        return 0
    up = Window.orderBy(F.desc("bin"))
    gain = F.sum("allow").over(up).cast(_LONG) * block - F.sum("block").over(up).cast(_LONG) * allow
    below = F.coalesce(F.lead("bin").over(up) + 1, F.col("bin"))
    cut = F.floor((below + F.col("bin")) * STEP / 2)
    return bins.select(gain.alias("gain"), cut.alias("cut")).orderBy(F.desc("gain"), F.abs("cut"), F.desc("cut")).first().cut


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Sequence[tuple[str, str, str]],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
    folds: int = FOLDS,
    **limits,
) -> DataFrame:
    """Per row of ``pages``: its id, ``host``, ``path``, ``rule``, ``verdict``, ``score`` and ``threshold``.

    ``rules`` are rows of host, path and verdict (``allow`` or ``block``); ``with_rules``
    says which one counts. Rows that no rule fits are allowed if their ``score`` (mean
    weight of a character, in millionths of a nat, rounded down) is at least ``threshold``.
    A URL that is null or has no ``://`` has an empty host and path; a null one is scored
    as an empty one. URLs of any length are scored whole. Without examples of one kind its
    model is that of equal shares, and without held-out ones the threshold is 0. Rows come
    out as often as they went in, null ids included, other columns are not read, and no
    rows give no rows.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    url = F.col("url")
    rows = pages.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(url_col), F.lit("")).alias("url")
    ).withColumns({"host": host_of(url), "path": path_of(url)})
    held = F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("bigint") % folds == 0
    rows = with_rules(rows, rules).withColumn("held", held)
    rows = settle(rows.select("id", "row", "url", "host", "path", "rule", "held"), "urls")
    model = train(rows.select("url", F.when(~F.col("held"), F.col("rule.verdict")).alias("example")), order)
    mean = F.floor(F.col("total") / F.col("length")).alias("mean")
    scored = score(rows, model, order, **limits).select("row", mean)
    scored = settle(rows.join(scored, "row").drop("row", "url"), "url-scores")
    threshold = calibrate(scored.select("mean", F.when(F.col("held"), F.col("rule.verdict")).alias("example")))
    release(rows)
    release(model)
    verdict = F.when(F.col("mean") >= threshold, "allow").otherwise("block")
    return scored.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("rule.text").alias("rule"),
        F.coalesce(F.col("rule.verdict"), verdict).alias("verdict"),
        F.col("mean").alias("score"),
        F.lit(threshold).cast("bigint").alias("threshold"),
    )


def keep_allowed(pages: DataFrame, rules, *, id_col: str = "page_id", url_col: str = "url", **options) -> DataFrame:
    """The rows of ``pages``, all columns, whose URL is allowed; equal URLs fare alike.

    Judged are its different URLs, so a frequent one counts once among the examples.
    """
    urls = pages.select(F.coalesce(F.col(url_col), F.lit("")).alias("_url")).distinct()
    judged = judge_urls(urls, rules, id_col="_url", url_col="_url", **options)
    blocked = judged.filter("verdict = 'block'").select(F.col("_url").alias("_waypost_url"))
    return pages.join(blocked, F.coalesce(F.col(url_col), F.lit("")) == F.col("_waypost_url"), "left_anti")
