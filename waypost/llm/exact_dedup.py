"""Exact dedup by deterministic block naming, with DataFrame functions only.

A text is cut into blocks of a fixed number of bytes. Each block gets an integer
name, adjacent names are paired, each pair gets a name, and so on until one name
stands for the text. A name is a 64-bit fingerprint together with the rank of the
block (or pair) among the different ones of that fingerprint, sorted by content. So
equal blocks get one name, different blocks never do, and names depend on nothing
but content. Nearly all ranks are 0; only what shares a fingerprint with something
else is ranked and looked up.

Each level is one pass over the distinct blocks or pairs, combined before the
shuffle: a block that a third of all texts hold crosses it once per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waypost.workspace import settle

#: Bytes in a block.
BLOCK_BYTES = 1024

#: Runs of ASCII white space but the single space, which is as it should be already.
#: (One class comes first, so that the matcher passes over other characters quickly.)
WHITE_SPACE = r"[\x20\x09-\x0D](?:(?<=[\x09-\x0D])|(?=[\x20\x09-\x0D]))[\x20\x09-\x0D]*"

#: Most groups of equal texts that are broadcast.
HOT_GROUPS = 10_000

_KEY = "_waypost_text_key"


def normalised(text: Column) -> Column:
    """``text`` with each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def fingerprint(value: Column) -> Column:
    return F.xxhash64(value)


def _blocks(data: Column, size: int) -> Column:
    """The blocks of a binary value; an empty value is one empty block."""
    last = F.greatest(F.ceil(F.length(data) / F.lit(size)).cast("int") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size))
    )


def _pairs(names: Column) -> Column:
    """Adjacent names two by two; the last of an odd number is paired with null."""
    return F.transform(
        F.sequence(F.lit(0), F.size(names) - 1, F.lit(2)),
        lambda i: F.struct(F.get(names, i).alias("left"), F.get(names, i + 1).alias("right")),
    )


def _named(texts: DataFrame, hashing) -> DataFrame:
    """``texts`` with the array ``parts`` replaced by ``names`` (fingerprint, rank)."""
    # The outer form keeps Spark from testing the array for emptiness first, at the cost
    # of making it twice; no array here is empty.
    flat = texts.select("row", F.posexplode_outer("parts").alias("pos", "part")).select(
        "row", "pos", hashing(F.col("part")).alias("print"), "part"
    )
    shared = settle(
        flat.select("print", "part").distinct().groupBy("print").count().filter("count > 1").select("print"),
        "shared-prints",
    )
    plain = F.transform(
        "parts", lambda p: F.struct(hashing(p).alias("print"), F.lit(0).alias("rank"))
    )
    if shared.isEmpty():
        return texts.withColumn("names", plain).drop("parts")
    hit = flat.join(shared, "print", "left_semi")
    ranked = (
        hit.select("print", "part")
        .distinct()
        .withColumn("rank", F.row_number().over(Window.partitionBy("print").orderBy("part")) - 1)
    )
    ranks = (
        hit.join(ranked.filter("rank > 0"), ["print", "part"])
        .groupBy("row")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "rank"))).alias("ranks"))
    )
    renamed = F.transform(
        plain,
        lambda x, i: F.struct(
            x["print"].alias("print"),
            F.coalesce(F.element_at("ranks", i), F.lit(0)).alias("rank"),
        ),
    )
    return texts.join(ranks, "row", "left").withColumn("names", renamed).drop("parts", "ranks")


def name_texts(
    docs: DataFrame, id_col: str, text_col: str, *, block: int = BLOCK_BYTES, hashing=fingerprint
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``sha256`` and ``name``.

    Two normalised texts are equal exactly when ``n_bytes`` and ``name`` are.
    ``sha256`` is of the normalised text in UTF-8.
    """
    data = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.encode(normalised(F.col(text_col)), "UTF-8").alias("data"),
    )
    first = data.select(
        "id",
        "row",
        F.length("data").cast("long").alias("n_bytes"),
        F.sha2("data", 256).alias("sha256"),
        _blocks(F.col("data"), block).alias("parts"),
    )
    open_ = settle(_named(first, hashing), "block-names")
    done = []
    # The longest text halves its names at each level.
    longest = open_.agg(F.max(F.size("names"))).first()[0] or 0
    while longest > 1:
        done.append(open_.filter(F.size("names") == 1))
        paired = open_.filter(F.size("names") > 1).withColumn("parts", _pairs(F.col("names")))
        open_ = settle(_named(paired.drop("names"), hashing), "pair-names")
        longest = (longest + 1) // 2
    named = reduce(DataFrame.unionByName, done, open_)
    return named.select("id", "n_bytes", "sha256", F.get("names", F.lit(0)).alias("name"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Which row stays of each group of equal texts.

    Returns one row per row of ``docs``: the id under its own name, ``keep_id`` (the
    smallest id of the group), ``group_size`` (rows), ``kept`` and ``text_sha256``.
    Other columns of ``docs`` are not read, whatever their names. A null text counts
    as empty; empty texts are one group. Null ids lose to any other id; a group with
    none but null ids keeps them. A row repeated with the same id is a row of its
    group each time, and all its copies have the same ``kept``. No rows give no rows.
    """
    named = settle(name_texts(docs, id_col, text_col, **options), "text-names")
    key = ["n_bytes", "name"]
    groups = named.groupBy(*key).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    # No more than HOT_GROUPS groups can each hold more than that share of all rows; these
    # are broadcast, and only the rows of small groups are shuffled to meet theirs.
    hot = groups.filter(F.col("group_size") > F.greatest(F.lit(2), F.lit(named.count()) / HOT_GROUPS))
    hot = settle(hot, "hot-groups")
    placed = named.join(F.broadcast(hot), key, "left")
    cold = placed.filter("keep_id IS NULL AND group_size IS NULL").drop("keep_id", "group_size")
    small = groups.join(F.broadcast(hot.select(*key)), key, "left_anti")
    found = placed.filter("group_size IS NOT NULL").unionByName(cold.join(small, key))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text another row has that stays.

    Rows repeated in id and text come out once, with the other columns of one of them.
    All columns of ``docs`` come out as they are.
    """

    def key(sha: Column) -> Column:
        return F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), sha)

    groups = exact_groups(docs, id_col, text_col, **options).filter("kept")
    kept = groups.select(key(F.col("text_sha256")).alias(_KEY)).distinct()
    sha = F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256)
    # One shuffle of the texts serves both the join and the repeated rows.
    return docs.withColumn(_KEY, key(sha)).join(kept, _KEY).dropDuplicates([_KEY]).select(*docs.columns)
