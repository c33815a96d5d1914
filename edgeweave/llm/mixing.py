"""Mixing of sources to target weights by temperature, in DataFrame functions only.

**Weights.** A source with the share ``s`` of all tokens gets the weight ``s ** a / sum(s ** a)``. The
exponent ``a`` lies between 0 (all sources alike) and 1 (as they come). It is found by bisection: the
largest one whose weights have at least ``entropy`` times the highest possible entropy, or the
smallest one at which no source is repeated more than ``repeats`` times; with both, the larger of
the two, so that the limit on repetition holds. Each pass over the table of sources halves the
interval ``LEVELS`` times by measuring every exponent those halvings could ask for.

A source far below the others asks for very many repetitions, so a limit on them holds by default. Without
one, the epochs of a document are unrolled in pieces that are shuffled apart, so no array and no task holds them all.

**Realisation.** A source's budget is its weight times the token budget. Its documents are read in
epochs; each epoch is a permutation of them by a hash of epoch and id, which falls into blocks by
the first hex digits of that hash. Whole epochs are taken whole, the last one up to the budget:
a document is taken when it begins before the budget's end. Where a document begins is the sum of
the blocks before its own plus a running sum in its block, so no task sees more than a block of
about ``block_docs`` documents, however large the source is. Rows that agree in id, source and tokens share the
hash; they are one row with a count until they are placed, so copies and null ids fill no block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgeweave.session import cut_lineage

ENTROPY, REPEATS, SEED, BLOCK_DOCS = 0.9, 16.0, 17, 4096
PIECE = 4096  # epochs or copies that are unrolled at once
HALVINGS, LEVELS = 30, 5


def token_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    words = F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def _measured(sizes: DataFrame, exponents: list[float]) -> list:
    """Entropy of the weights and the largest weight per share, for each exponent."""
    power = F.pow("share", F.col("a"))
    by = sizes.withColumn("a", F.explode(F.array(*map(F.lit, exponents))))
    by = by.groupBy("a").agg(
        F.sum(power).alias("z"),
        F.sum(power * F.log("share")).alias("logs"),
        F.max(power / F.col("share")).alias("most"),
    )
    return by.select("a", (F.log("z") - F.col("a") * F.col("logs") / F.col("z")).alias("entropy"), (F.col("most") / F.col("z")).alias("ratio")).collect()


def _bisect(sizes: DataFrame, holds, rising: bool) -> float:
    """End of the interval in [0, 1] where ``holds`` is true: from 0 up, or with ``rising`` from 1 down."""
    edge = {r["a"]: holds(r) for r in _measured(sizes, [0.0, 1.0])}
    if not edge:
        return 1.0
    if edge[0.0 if rising else 1.0]:
        return 0.0 if rising else 1.0
    low, high, done = 0.0, 1.0, 0
    while done < HALVINGS:
        parts = 1 << LEVELS
        inner = [low + (high - low) * i / parts for i in range(1, parts)]
        true = {r["a"]: holds(r) for r in _measured(sizes, inner)}
        for _ in range(LEVELS):
            middle = (low + high) / 2
            if true[middle] == rising:
                high = middle
            else:
                low = middle
        done += LEVELS
    return high if rising else low


def exponent(sizes: DataFrame, ratio: float, entropy: float | None, repeats: float | None) -> float:
    """The exponent for ``sizes (share)``; ``ratio`` is the token budget over all tokens."""
    found = []
    if entropy is not None:
        highest = sizes.agg(F.log(F.count(F.lit(1)).cast("double"))).first()[0]
        found.append(_bisect(sizes, lambda r: r["entropy"] >= entropy * highest, rising=False) if highest else 1.0)
    if repeats is not None:
        found.append(_bisect(sizes, lambda r: r["ratio"] * ratio <= repeats, rising=True))
    return max(found, default=1.0)


def source_weights(
    counted: DataFrame, ratio: float = 1.0, entropy: float | None = ENTROPY, repeats: float | None = REPEATS
) -> DataFrame:
    """Per source of ``counted (source, tokens, rows)``: ``(source, docs, tokens, weight, budget)``.

    Sources without tokens have no weight and no row.
    """
    sizes = counted.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("tokens") * F.col("rows")).alias("tokens"))
    sizes = cut_lineage(sizes.filter("tokens > 0"))
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    shares = sizes.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    a = exponent(shares, ratio, entropy, repeats)
    z = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    return shares.select(
        "source", "docs", "tokens", weight.alias("weight"), F.floor(weight * F.lit(float(total) * ratio)).alias("budget")
    )


def _unrolled(rows: DataFrame, count: Column, name: str, apart: list[str] | None) -> DataFrame:
    """Each row ``count`` times, numbered from 0 as ``name``; ``apart`` names columns to shuffle by between two steps.

    No array has more than ``PIECE`` items below ``PIECE ** 3``.
    """
    zero, size = F.lit(0).cast("long"), F.lit(PIECE).cast("long")

    def pieces(total: Column, width: Column) -> Column:
        return F.explode(F.sequence(zero, F.floor((total - 1) / width)))

    square = size * size
    out = rows.withColumn("left", count.cast("long")).filter("left > 0").withColumn("outer", pieces(F.col("left"), square))
    out = out.withColumn("left", F.least(F.col("left") - F.col("outer") * square, square)).withColumn("inner", pieces(F.col("left"), size))
    out = out.withColumn("left", F.least(F.col("left") - F.col("inner") * size, size))
    out = out.repartition(*apart, "outer", "inner") if apart else out
    number = F.col("outer") * square + F.col("inner") * size + F.col("at")
    return out.withColumn("at", F.explode(F.sequence(zero, F.col("left") - 1))).withColumn(name, number).drop("left", "outer", "inner", "at")


def mixture(
    docs: DataFrame,
    ratio: float = 1.0,
    entropy: float | None = ENTROPY,
    repeats: float | None = REPEATS,
    seed: int = SEED,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``(doc_id, source, tokens, epoch, place)``: one row per taken document and epoch.

    ``place`` is the number of the source's tokens before it in that epoch. ``ratio`` times all
    tokens is the budget; no source's budget is more than about ``repeats`` times its tokens, None sets no limit. A
    null source is a source of its own, a null or empty text has no tokens, a very long one is one document,
    a null id is permuted like the id ``null``; repeated rows are documents of their own. Documents
    of sources without any token are not taken. An empty table gives no rows; columns beyond
    ``doc_id``, ``source`` and ``text`` are ignored.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", token_count(F.col("text")).alias("tokens"))
    counted = cut_lineage(counted.groupBy("doc_id", "source", "tokens").agg(F.count(F.lit(1)).alias("rows")))
    weights = cut_lineage(source_weights(counted, ratio, entropy, repeats))
    digits = F.ceil(F.log(F.col("docs") / block_docs) / F.log(F.lit(16.0)))
    plan = weights.select(
        F.col("source").alias("of"),
        F.expr("budget div tokens").alias("whole"),
        F.expr("budget % tokens").alias("rest"),
        F.greatest(F.lit(0), digits).cast("int").alias("digits"),
    )
    rows = counted.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = _unrolled(rows, F.col("whole") + 1, "epoch", ["doc_id", "source"] if repeats is None else None)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = rows.withColumn("key", key).withColumn("block", F.substring("key", F.lit(1), F.col("digits")))
    block = ["source", "epoch", "block"]
    before = Window.partitionBy(*block).orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("all", F.col("tokens") * F.col("rows"))
    rows = rows.withColumn("inside", F.coalesce(F.sum("all").over(before), F.lit(0)))
    blocks = rows.groupBy(*block).agg(F.sum("all").alias("size"))
    earlier = Window.partitionBy("source", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        *(F.col(c).alias(f"_{c}") for c in block), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in block]
    placed = rows.join(starts, same).withColumn("place", F.col("start") + F.col("inside"))
    # of equal rows in the last epoch, those that begin before the budget's end
    begun = F.when(F.col("tokens") == 0, F.col("rows")).otherwise(F.ceil((F.col("rest") - F.col("place")) / F.greatest(F.col("tokens"), F.lit(1))))
    count = F.when(F.col("epoch") < F.col("whole"), F.col("rows")).when(F.col("place") < F.col("rest"), F.least("rows", begun)).otherwise(0)
    most = counted.agg(F.max("rows")).first()[0] or 0
    placed = placed.select("doc_id", "source", "tokens", "epoch", "place", count.alias("count"))
    taken = _unrolled(placed, F.col("count"), "copy", ["doc_id", "source", "epoch"] if most > PIECE else None)
    return taken.select("doc_id", "source", "tokens", "epoch", (F.col("place") + F.col("copy") * F.col("tokens")).alias("place"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixture`` takes it, with all their columns, whatever their names.

    Copies of rows that agree in id, source and token count are dealt to those rows in turn. Null texts and ids,
    repeated rows and empty tables are as for ``mixture``.
    """
    key = ["doc_id", "source", "tokens"]
    copies = mixture(docs, **options).groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.select(F.struct(*key, "copies").alias("mixed"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), token_count(F.col("text")).alias("size"))  # names of their own, in a struct
    turn = Window.partitionBy("row.doc_id", "row.source", "size")
    rows = rows.withColumn("turn", F.row_number().over(turn.orderBy(F.xxhash64("row"))) - 1)
    rows = rows.withColumn("rows", F.count(F.lit(1)).over(turn))
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("mixed.doc_id"))
        & F.col("row.source").eqNullSafe(F.col("mixed.source"))
        & (F.col("size") == F.col("mixed.tokens"))
    )
    dealt = rows.join(copies, same).select("row", F.expr("(mixed.copies + rows - 1 - turn) div rows").alias("share"))
    each = dealt.filter("share > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("share"))).alias("copy"))
    return each.select("row.*")


#: DuckDB SQL for ``mixture`` with its default options over the table ``documents``.
MIXTURE_SQL = r"""
WITH RECURSIVE counted AS MATERIALIZED (
  SELECT doc_id, source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '')) AS tokens
  FROM documents),
sizes AS MATERIALIZED (
  SELECT source, sum(tokens)::BIGINT AS tokens FROM counted GROUP BY source HAVING sum(tokens) > 0),
all_shares AS MATERIALIZED (
  SELECT list(tokens / (SELECT sum(tokens) FROM sizes)::DOUBLE) AS s, ln(count(*)::DOUBLE) AS highest,
         sum(tokens)::DOUBLE AS total FROM sizes),
halving(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN holds THEN middle ELSE low END, CASE WHEN holds THEN high ELSE middle END
  FROM (SELECT step, low, high, middle, ln(z) - middle * logs / z >= 0.9 * highest AS holds
        FROM (SELECT step, low, high, (low + high) / 2 AS middle, highest,
                     list_sum(list_transform(s, lambda x: pow(x, (low + high) / 2))) AS z,
                     list_sum(list_transform(s, lambda x: pow(x, (low + high) / 2) * ln(x))) AS logs
              FROM halving, all_shares WHERE step < 30))),
repeating(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN holds THEN low ELSE middle END, CASE WHEN holds THEN middle ELSE high END
  FROM (SELECT step, low, high, (low + high) / 2 AS middle,
               list_max(list_transform(s, lambda x: pow(x, (low + high) / 2) / x))
                 / list_sum(list_transform(s, lambda x: pow(x, (low + high) / 2))) <= 16.0 AS holds
        FROM repeating, all_shares WHERE step < 30)),
found AS (
  SELECT greatest(
           CASE WHEN -list_sum(list_transform(s, lambda x: x * ln(x))) >= 0.9 * highest THEN 1.0
                ELSE (SELECT low FROM halving WHERE step = 30) END,
           CASE WHEN list_max(list_transform(s, lambda x: 1 / x)) / len(s) <= 16.0 THEN 0.0
                ELSE (SELECT high FROM repeating WHERE step = 30) END) AS a FROM all_shares),
weights AS (
  SELECT source, tokens AS size,
         floor(pow(tokens / total, a) / (SELECT list_sum(list_transform(s, lambda x: pow(x, a))) FROM all_shares, found)
               * total)::BIGINT AS budget
  FROM sizes, all_shares, found),
epochs AS (
  SELECT c.doc_id, c.source, c.tokens, budget // size AS whole, budget % size AS rest,
         unnest(range(0, budget // size + 1)) AS epoch
  FROM counted c JOIN weights w ON c.source IS NOT DISTINCT FROM w.source),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (
           PARTITION BY source, epoch
           ORDER BY md5('17|' || epoch || '|' || coalesce(doc_id::VARCHAR, 'null')), tokens
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM epochs)
SELECT doc_id, source, tokens::BIGINT AS tokens, epoch::BIGINT AS epoch, place
FROM placed WHERE epoch < whole OR place < rest
"""
