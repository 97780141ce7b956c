"""Reproducible samples, splits and blocks.

The order of every sample is that of an MD5 key of seed and id, so it is the
same in any engine and for any partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acequia.functions.text import shuffle_key
from acequia.operators.ordering import position, running


def largest_remainder(sizes: DataFrame, group: str, size: str, target: int) -> DataFrame:
    """(group, budget): shares of a target in proportion to sizes, in whole numbers that add up to it.

    What is left after rounding down goes to the largest remainders, ties in
    order of group. ``sizes`` has one row by group.
    """
    whole = Window.partitionBy(F.lit(1))
    exact = F.col(size) / F.sum(size).over(whole) * F.lit(target)
    shares = sizes.select(group, exact.alias("exact"), F.floor(exact).alias("base"))
    left = F.lit(target) - F.sum("base").over(whole)
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("exact") - F.col("base")), group))
    return shares.select(group, F.when(rank <= left, F.col("base") + 1).otherwise(F.col("base")).cast("bigint").alias("budget"))


def take_tokens(df: DataFrame, budgets: DataFrame, group: str, id_column: str, tokens: str, seed: int) -> DataFrame:
    """Of each group, the rows in shuffled order while their tokens fit its budget; groups without one are left out."""
    keyed = df.join(budgets.withColumnRenamed("budget", "__budget"), group).withColumn("__key", shuffle_key(F.col(id_column), seed))
    summed = running(keyed, [group], "__key", [id_column], F.col(tokens), "__sum")
    return summed.where(F.col("__sum") <= F.col("__budget")).select(*df.columns)


def take_rows(df: DataFrame, budgets: DataFrame, group: str, id_column: str, seed: int) -> DataFrame:
    """Of each group, as many rows in shuffled order as its budget says; groups without one are left out."""
    keyed = df.join(budgets.withColumnRenamed("budget", "__budget"), group).withColumn("__key", shuffle_key(F.col(id_column), seed))
    ranked = running(keyed, [group], "__key", [id_column], F.lit(1), "__rank")
    return ranked.where(F.col("__rank") <= F.col("__budget")).select(*df.columns)


def _sizes(df: DataFrame, group: str, value: Column) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(value.alias("size"))


def tokens_stratified(df: DataFrame, target: int, group: str = "source", id_column: str = "doc_id", tokens: str = "tokens", seed: int = 42) -> DataFrame:
    """A sample of ``target`` tokens with each group's share of them as in the whole."""
    budgets = largest_remainder(_sizes(df, group, F.sum(tokens)).where("size > 0"), group, "size", target)
    return take_tokens(df, budgets, group, id_column, tokens, seed)


def tokens_equal(df: DataFrame, each: int, group: str = "source", id_column: str = "doc_id", tokens: str = "tokens", seed: int = 42) -> DataFrame:
    """Up to ``each`` tokens of every group."""
    budgets = _sizes(df, group, F.sum(tokens)).select(group, F.lit(each).alias("budget"))
    return take_tokens(df, budgets, group, id_column, tokens, seed)


def _mapping(df: DataFrame, group: str, targets: dict[str, int]) -> DataFrame:
    kind = df.schema[group].dataType.simpleString()
    return df.sparkSession.createDataFrame(list(targets.items()), f"`{group}` {kind}, budget bigint")


def tokens_by_group(df: DataFrame, targets: dict[str, int], group: str = "source", id_column: str = "doc_id", tokens: str = "tokens", seed: int = 42) -> DataFrame:
    """Listed groups cut to their tokens; others, rows without a group among them, whole. An empty list keeps all."""
    if not targets:
        return df
    others = df.where(~F.coalesce(F.col(group).isin(list(targets)), F.lit(False)))
    return take_tokens(df, _mapping(df, group, targets), group, id_column, tokens, seed).unionByName(others)


def rows_stratified(df: DataFrame, target: int, group: str = "source", id_column: str = "doc_id", seed: int = 42) -> DataFrame:
    """A sample of ``target`` rows with each group's share as in the whole."""
    return take_rows(df, largest_remainder(_sizes(df, group, F.count("*")), group, "size", target), group, id_column, seed)


def rows_equal(df: DataFrame, each: int, group: str = "source", id_column: str = "doc_id", seed: int = 42) -> DataFrame:
    """Up to ``each`` rows of every group."""
    return take_rows(df, _sizes(df, group, F.count("*")).select(group, F.lit(each).alias("budget")), group, id_column, seed)


def rows_by_group(df: DataFrame, targets: dict[str, int], group: str = "source", id_column: str = "doc_id", seed: int = 42) -> DataFrame:
    """Listed groups cut to their numbers of rows; others whole. An empty list keeps all."""
    if not targets:
        return df
    others = df.where(~F.coalesce(F.col(group).isin(list(targets)), F.lit(False)))
    return take_rows(df, _mapping(df, group, targets), group, id_column, seed).unionByName(others)


def category_share(df: DataFrame, target: int, by_tokens: bool, group: str, id_column: str, tokens: str = "tokens", seed: int = 42) -> DataFrame:
    """Each category's share of a target, rounded down; a category no larger than its share is kept whole."""
    size = F.sum(tokens) if by_tokens else F.count("*")
    sizes = _sizes(df, group, size)
    share = F.floor(F.col("size") / F.sum("size").over(Window.partitionBy(F.lit(1))) * target)
    budgets = sizes.select(group, share.cast("bigint").alias("budget"))
    take = take_tokens(df, budgets, group, id_column, tokens, seed) if by_tokens else take_rows(df, budgets, group, id_column, seed)
    return take


def category_listed(df: DataFrame, targets: dict[str, int] | int, by_tokens: bool, group: str, id_column: str, tokens: str = "tokens", seed: int = 42) -> DataFrame:
    """Only listed categories, each up to its own target, or every one up to a single target."""
    if isinstance(targets, int):
        budgets = _sizes(df, group, F.count("*")).select(group, F.lit(targets).alias("budget"))
    else:
        budgets = _mapping(df, group, targets)
    return take_tokens(df, budgets, group, id_column, tokens, seed) if by_tokens else take_rows(df, budgets, group, id_column, seed)


def balanced(df: DataFrame, most: int, group: str, id_column: str, seed: int = 42) -> DataFrame:
    """At most ``most`` rows, as evenly over the groups as their sizes allow.

    Each group gets an equal part; what doesn't divide goes one by one to the
    first groups in order of name; a group that is smaller gives what it has.
    """
    sizes = _sizes(df, group, F.count("*"))
    n = F.count("*").over(Window.partitionBy(F.lit(1)))
    place = F.row_number().over(Window.orderBy(group))
    budget = F.floor(F.lit(most) / n) + F.when(place <= F.lit(most) % n, 1).otherwise(0)
    return take_rows(df, sizes.select(group, F.least("size", budget.cast("bigint")).alias("budget")), group, id_column, seed)


def split_sizes(df: DataFrame, id_column: str, sizes: dict[str, int], rest: str, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: in shuffled order, first the given numbers of rows, then the rest.

    Raises if there are fewer rows than asked for.
    """
    total, wanted = df.count(), sum(sizes.values())
    if total < wanted:
        raise ValueError(f"{total} rows, {wanted} asked for")
    return _split(df, id_column, sizes, rest, seed)


def split_shares(df: DataFrame, id_column: str, shares: dict[str, float], rest: str, seed: int = 42) -> DataFrame:
    """``df`` with ``split``: in shuffled order, first the given shares of rows rounded down, then the rest."""
    total = df.count()
    return _split(df, id_column, {k: int(total * v) for k, v in shares.items()}, rest, seed)


def _split(df: DataFrame, id_column: str, sizes: dict[str, int], rest: str, seed: int) -> DataFrame:
    keyed = df.withColumn("__key", shuffle_key(F.col(id_column), seed))
    ranked = running(keyed, [], "__key", [id_column], F.lit(1), "__rank")
    out, upto = None, 0
    for name, n in sizes.items():
        upto += n
        out = (F if out is None else out).when(F.col("__rank") <= upto, name)
    label = F.lit(rest) if out is None else out.otherwise(rest)
    return ranked.select(*df.columns, label.alias("split"))


def split_groups(df: DataFrame, group: str, share: float, seed: int = 42) -> DataFrame:
    """``df`` with ``split`` eval or train by group: no group is in both, and eval has one at least."""
    keys = df.select(group).distinct()
    total = keys.count()
    n = max(1, int(total * share)) if total else 0
    ranked = running(keys.withColumn("__key", shuffle_key(F.col(group), seed)), [], "__key", [group], F.lit(1), "__rank")
    label = ranked.select(F.col(group).alias("__group"), F.when(F.col("__rank") <= n, "eval").otherwise("train").alias("split"))
    return df.join(label, F.col(group).eqNullSafe(F.col("__group"))).select(*df.columns, "split")


def contiguous_parts(df: DataFrame, order: list[str], parts: int) -> DataFrame:
    """``df`` with ``part`` 0 .. parts-1: runs of total // parts rows in order, the remainder in the last."""
    size = max(1, df.count() // parts)
    placed = position(df, order, "__place")
    return placed.select(*df.columns, F.least(F.floor(F.col("__place") / size), F.lit(parts - 1)).cast("int").alias("part"))


def annotation_blocks(df: DataFrame, gold: DataFrame, id_column: str, per_block: int = 50, gold_per_block: int = 5, seed: int = 42) -> DataFrame:
    """(block, place, id, is_gold): shuffled rows in blocks, each with gold items of its own drawing, shuffled again.

    ``gold`` is the short list of items with a known label, read by every
    block: at most 10,000 of them.
    """
    keyed = df.select(F.col(id_column).cast("string").alias("id")).withColumn("__key", shuffle_key(F.col("id"), seed))
    ranked = running(keyed, [], "__key", ["id"], F.lit(1), "__rank")
    rows = ranked.select(F.floor((F.col("__rank") - 1) / per_block).cast("int").alias("block"), "id")
    items = [r[0] for r in gold.select(F.col(gold.columns[0]).cast("string")).distinct().limit(10_001).collect()]
    if len(items) > 10_000:
        raise ValueError("more than 10,000 gold items")
    listed = F.array(*[F.lit(x) for x in sorted(items)]) if items else F.array().cast("array<string>")
    drawn = F.slice(F.array_sort(F.transform(listed, lambda x: F.struct(F.md5(F.concat(F.lit(f"{seed}|"), F.col("block").cast("string"), F.lit("|"), x)).alias("k"), x.alias("id")))), 1, gold_per_block)
    golds = rows.select("block").distinct().select("block", F.explode(drawn["id"]).alias("id"), F.lit(True).alias("is_gold"))
    both = rows.withColumn("is_gold", F.lit(False)).unionByName(golds)
    order = Window.partitionBy("block").orderBy(F.md5(F.concat(F.lit(f"{seed}|place|"), "id")), "id", "is_gold")  # at most per_block + gold_per_block rows
    return both.select("block", F.row_number().over(order).alias("place"), "id", "is_gold")


def topic_quota(df: DataFrame, topic: str, text: str, id_column: str, *, rate: float = 0.33, least: int = 3, most: int = 50, bands: tuple[int, int] = (100, 300), smallest_topic: int = 10, seed: int = 42) -> DataFrame:
    """Of each topic with enough rows, a quota of rows: one of each length band first, then others in shuffled order.

    The quota is the rounded rate of the topic's rows within [least, most].
    """
    short, long = bands
    band = F.when(F.length(text) <= short, 0).when(F.length(text) <= long, 1).otherwise(2)
    keyed = df.withColumn("__band", band).withColumn("__key", shuffle_key(F.col(id_column), seed))
    sizes = keyed.groupBy(topic).agg(F.count("*").alias("__n")).where(F.col("__n") >= smallest_topic)
    quota = sizes.select(topic, F.greatest(F.least(F.round(F.col("__n") * rate), F.lit(most)), F.lit(least)).alias("__quota"))
    firsts = keyed.groupBy(topic, "__band").agg(F.min(F.struct("__key", id_column)).alias("f")).select(topic, F.col(f"f.{id_column}").alias(id_column), "__band")
    marked = keyed.join(firsts.withColumn("__first", F.lit(True)), [topic, id_column, "__band"], "left")
    # the firsts of the bands come before all others: their keys begin with zeros, the others' with a one
    order = F.when(F.col("__first"), F.concat(F.lit("000"), F.col("__band").cast("string"), "__key")).otherwise(F.concat(F.lit("1"), "__key"))
    ordered = marked.withColumn("__order", order).join(quota, topic)
    ranked = running(ordered, [topic], "__order", [id_column], F.lit(1), "__rank")
    return ranked.where(F.col("__rank") <= F.col("__quota")).select(*df.columns)


def trim_to_total(sample: DataFrame, topic: str, id_column: str, total: int, least: int = 3, seed: int = 42) -> DataFrame:
    """A sample over its total loses one row of each of its largest topics, as many topics as it is over by.

    Topics of ``least`` rows or fewer lose none; so the total may stay above.
    """
    excess = max(0, sample.count() - total)
    sizes = sample.groupBy(topic).agg(F.count("*").alias("__n"), F.max(F.struct(shuffle_key(F.col(id_column), seed).alias("k"), F.col(id_column).alias("i"))).alias("l"))
    cut = sizes.where(F.col("__n") > least).orderBy(F.desc("__n"), topic).limit(excess).select(F.col("l.i").alias(id_column))
    return sample.join(cut, id_column, "left_anti")


def fill_to_total(sample: DataFrame, df: DataFrame, topic: str, id_column: str, total: int, seed: int = 42) -> DataFrame:
    """A sample below its total gets rows it lacks, from the topics with most left, as many of each as any."""
    missing = max(0, total - sample.count())
    rest = df.select(id_column, topic).join(sample.select(id_column), id_column, "left_anti").withColumn("__key", shuffle_key(F.col(id_column), seed))
    ranked = running(rest, [topic], "__key", [id_column], F.lit(1), "__rank")
    left = rest.groupBy(F.struct(F.col(topic).alias("v")).alias("__t")).agg(F.count("*").alias("__left"))
    ordered = ranked.withColumn("__t", F.struct(F.col(topic).alias("v"))).join(left, "__t").orderBy("__rank", F.desc("__left"), "__key", id_column)
    # ids are put in order, rows picked by them
    return sample.unionByName(df.join(ordered.limit(missing).select(id_column), id_column, "left_semi").select(*sample.columns))


def uniform(df: DataFrame, n: int, id_column: str, seed: int = 42) -> DataFrame:
    """n rows, each as likely as any other: the least keys. A top-n, of which each task keeps n at most."""
    return df.withColumn("__key", shuffle_key(F.col(id_column), seed)).orderBy("__key", id_column).limit(n).drop("__key")


def styles(df: DataFrame, names: list[str], id_column: str, every: bool, seed: int = 42) -> DataFrame:
    """Each row with one style by the hash of its id, or with every one."""
    listed = F.array(*[F.lit(n) for n in names])
    if every:
        return df.withColumn("style", F.explode(listed))
    at = F.conv(F.substring(shuffle_key(F.col(id_column), seed), 1, 8), 16, 10).cast("bigint") % len(names)
    return df.withColumn("style", F.element_at(listed, (at + 1).cast("int")))


#: Tasks by name; dashes and a leading ``downsampling-`` are allowed.
TASKS: dict[str, Callable[..., DataFrame]] = {
    "tokens_general_stratified": tokens_stratified,
    "tokens_general_equitative": tokens_equal,
    "tokens_per_source": tokens_by_group,
    "documents_general_stratified": rows_stratified,
    "documents_general_equitative": rows_equal,
    "documents_per_source": rows_by_group,
}


def perform(task: str, df: DataFrame, **options: object) -> DataFrame:
    """The sampling task of that name; raises for an unknown one."""
    name = task.replace("-", "_").removeprefix("downsampling_")
    if name not in TASKS:
        raise ValueError(f"unknown task {task}; known: {', '.join(TASKS)}")
    return TASKS[name](df, **options)
