"""Preference pairs: why one is rejected, duplicates, audit and judging."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acequia.functions.measures import bleu_column, chrf_column, length_ratio
from acequia.functions.text import hash_parts, squeeze, token_count
from acequia.operators import alike
from acequia.operators.filters import reasons
from acequia.operators.minhash import signatures
from acequia.session import materialize

#: Texts, and characters of them, that ``near_pairs`` holds in a block; a task holds two at most.
BLOCK_TEXTS, BLOCK_CHARS = 80_000, 80_000_000


def measured(df: DataFrame) -> DataFrame:
    """Prompt, chosen and rejected squeezed, with tokens, ratio, chrF and BLEU of chosen against rejected."""
    flat = df.withColumns({c: squeeze(F.col(c)) for c in ("prompt", "chosen", "rejected")})
    sized = flat.withColumns({"chosen_tokens": token_count(F.col("chosen")), "rejected_tokens": token_count(F.col("rejected"))})
    return sized.withColumns(
        {"length_ratio": length_ratio(F.col("chosen_tokens"), F.col("rejected_tokens")), "chrf": chrf_column("chosen", "rejected"), "bleu": bleu_column("chosen", "rejected")}
    )


def empty_reasons() -> Column:
    return reasons(**{f"empty_{c}": F.col(c) == "" for c in ("prompt", "chosen", "rejected")})


def reject_reasons(least: int = 20, low: float = 0.25, high: float = 4.0, chrf: float | None = 0.9, bleu: float | None = 0.9) -> Column:
    """All reasons of a measured pair; an empty field is the only reason of its pair. None switches a measure off."""
    tests = {"short_rejected": F.col("rejected_tokens") < least, "length_ratio_too_low": F.col("length_ratio") < low, "length_ratio_too_high": F.col("length_ratio") > high}
    if chrf is not None:
        tests["high_chrf"] = F.col("chrf") > chrf
    if bleu is not None:
        tests["high_bleu"] = F.col("bleu") > bleu
    return F.when(F.size(empty_reasons()) > 0, empty_reasons()).otherwise(reasons(**tests))


def with_duplicates(df: DataFrame, order: list[str], reasons_column: str = "reasons", by_prompt: bool = True) -> DataFrame:
    """``df`` with the reason duplicate_prompt_chosen or duplicate_prompt added to later rows of a prompt.

    Of the rows without a reason the first of each prompt stays; a later one
    is a duplicate of prompt and chosen if its chosen is the first one's.
    Without ``by_prompt`` only equal pairs are duplicates.
    """
    prompt, pair = hash_parts(F.col("prompt")), hash_parts(F.col("prompt"), F.col("chosen"))
    key = prompt if by_prompt else pair
    place = F.struct(*order)
    firsts = df.where(F.size(reasons_column) == 0).groupBy(key.alias("__k")).agg(F.min(F.struct(place.alias("at"), pair.alias("pair"))).alias("__f"))
    joined = df.withColumn("__k", key).join(firsts, "__k", "left")
    later = (F.size(reasons_column) == 0) & (F.col("__f.at") != place)
    name = F.when(F.col("__f.pair") == pair, "duplicate_prompt_chosen").otherwise("duplicate_prompt")
    return joined.select(*[c for c in df.columns if c != reasons_column], F.when(later, F.array(name)).otherwise(F.col(reasons_column)).alias(reasons_column))


def near_pairs(df: DataFrame, id_column: str, ratio: float = 0.94, bucket: int = 25, bands: int = 32, rows: int = 4) -> DataFrame:
    """(a, b, ratio): texts of prompt and chosen that are alike by difflib's ratio.

    Equal texts are one class, compared by its least id: each further copy b
    is given once, beside that id as a, with a ratio of 1. Of different texts
    both must be of one length bucket of prompt and chosen tokens. Candidates
    share a MinHash band of pairs of words, so that no bucket is compared all
    with all. That isn't complete for a ratio of characters: many small edits
    leave few pairs of words, and texts of one word aren't compared.

    A length bucket's texts go to one task, which finds the candidates and
    compares them, so neither band keys nor pairs with their texts are
    moved. A bucket of more than a block is dealt to several, each two a task.
    """
    text = F.concat_ws("\n", squeeze(F.col("prompt")), squeeze(F.col("chosen")))
    size = lambda c: F.floor(token_count(squeeze(F.col(c))) / bucket)
    flat = df.select(F.col(id_column).alias("id"), text.alias("t"), size("prompt").alias("p"), size("chosen").alias("c"))
    hashed = flat.select("id", "t", F.unhex(F.sha2("t", 256)).alias("h"), "p", "c")
    # equal texts are of one bucket and one length
    classes = hashed.groupBy("h").agg(F.min("id").alias("a"), F.min("p").alias("p"), F.min("c").alias("c"), F.min(F.length("t")).alias("n"))
    classes = materialize(classes, "classes")
    copies = hashed.select(F.col("id").alias("b"), "h").join(classes, "h").where("a <> b").select("a", "b", F.lit(1.0).alias("ratio")).distinct()
    # a bucket of one class has nothing to compare
    buckets = classes.groupBy("p", "c").agg(F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("n") / BLOCK_CHARS)).cast("int").alias("blocks"), F.count("*").alias("among")).where("among > 1")
    firsts = classes.join(buckets, ["p", "c"]).select(F.col("a").alias("id"), "h", "p", "c", "blocks")
    texts = hashed.select("id", "h", "t").join(firsts, ["id", "h"])
    signed = signatures(texts, "t", "id", 2, bands, rows, ("t", "p", "c", "h", "blocks"))
    mine = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, mine).alias("x"), F.greatest(o, mine).alias("y")))
    # 31 bits of a key: few more texts meet, and every pair is compared
    keyed = signed.select("id", "t", F.transform("keys", lambda k: k.bitwiseAND(0x7FFFFFFF).cast("int")).alias("keys"), mine.alias("block"), "p", "c", F.explode(cells).alias("cell"))

    def compare(cell: pa.Table) -> pa.Table:
        keys = cell["keys"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, bands)
        x, y = alike.candidates(keys, cell["block"].to_numpy(), (t.as_py() for t in cell["t"]), ratio)
        out: dict[str, list] = {"a": [], "b": [], "ratio": []}
        for i, j in zip(x.tolist(), y.tolist()):
            (a, s), (b, t) = sorted(((cell["id"][k].as_py(), cell["t"][k].as_py()) for k in (i, j)))
            if a < b and (r := round(alike.alike(s, t, ratio), 6)) >= ratio:
                out["a"].append(a)
                out["b"].append(b)
                out["ratio"].append(r)
        kind = cell.schema.field("id").type
        return pa.table({"a": pa.array(out["a"], kind), "b": pa.array(out["b"], kind), "ratio": pa.array(out["ratio"], pa.float64())})

    id_type = flat.schema["id"].dataType.simpleString()
    near = keyed.groupBy("p", "c", "cell").applyInArrow(compare, f"a {id_type}, b {id_type}, ratio double")
    return near.distinct().unionByName(copies)


def judge_pairs(a: DataFrame, b: DataFrame, key: str, order: list[str], response: str, seed: int = 42) -> DataFrame:
    """(key, first, second, swapped): both models' answers to a prompt, in an order that a hash decides."""
    from acequia.operators.joins import answered_by_both

    both = answered_by_both(a, b, key, order, response)
    swapped = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), 1, 1), 16, 10).cast("int") % 2 == 1
    x, y = F.col(f"{response}_a"), F.col(f"{response}_b")
    return both.select(key, F.when(swapped, y).otherwise(x).alias("first"), F.when(swapped, x).otherwise(y).alias("second"), swapped.alias("swapped"))


def judged(df: DataFrame, winner: str, confidence: str, least: int = 1) -> DataFrame:
    """(…, chosen, rejected) of judged pairs with a winner and enough confidence; ties are left out."""
    sure = df.where(F.upper(winner).isin("A", "B") & (F.col(confidence) >= least))
    a = F.upper(winner) == "A"
    return sure.select("*", F.when(a, F.col("first")).otherwise(F.col("second")).alias("chosen"), F.when(a, F.col("second")).otherwise(F.col("first")).alias("rejected"))
