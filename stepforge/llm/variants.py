"""Grouping spelling variants: words one edit apart, found on a trie kept as a table.

The words form two tries, one of their symbols in order and one of their
symbols reversed, each word closed by an end sign. A node is known by the hash
of the symbols that lead to it, and an edge spans a stretch of symbols, its
label. States ``(word, position, node, edits)`` start on each word's own path,
with no edit, in the second half of the word: an edit in the first half is met
by the reversed trie, so states never start at nodes that many words share.

Level one joins every state with the edges of its node and edits one symbol:
a replaced symbol is any other first symbol of an edge whose following label
agrees, a deleted one is passed over without leaving the node. An insertion is
the deletion seen from the other word. Each later level joins the states with
one edit with edges of twice the length by node and label, so a word of n
symbols needs about log2(n) levels, and a table of edges holds only words long
enough to have them. States that reach the end sign are the neighbours; they
are compared once more by their symbols, as nodes are hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.llm.common import Scratch

END = "$"
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(df: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, drop_one_in: int | None) -> DataFrame:
    """``word, n`` of the runs of letters with enough symbols and occurrences.

    With ``drop_one_in``, a run whose checksum with its document's id is
    divisible by it loses one symbol.
    """
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    words = runs.filter(F.length("run") >= min_length).select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if drop_one_in:
        words = words.withColumn("sum", F.crc32(F.concat_ws(":", "id", "word").cast("binary")))
        shorter = F.expr("substring(word, 1, cast(sum % length(word) as int)) || substring(word, cast(sum % length(word) as int) + 2)")
        words = words.select(F.when(F.col("sum") % drop_one_in == 0, shorter).otherwise(F.col("word")).alias("word"))
        words = words.filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def part(begin: str, length: str) -> Column:
    """Symbols from ``begin``, counted from 0."""
    return F.expr(f"substring(symbols, {begin} + 1, {length})")


def on_tries(words: DataFrame) -> DataFrame:
    """Each word on both tries, at every node from the middle of the word (``low``) to its end (``size``)."""
    return (
        words.select("word", "n", F.length("word").alias("size"), F.posexplode(F.array("word", F.reverse("word"))).alias("way", "symbols"))
        .withColumn("symbols", F.concat("symbols", F.lit(END)))
        .withColumn("low", F.when(F.col("way") == 0, F.floor(F.col("size") / 2)).otherwise(F.col("size") - F.floor(F.col("size") / 2)).cast("int"))
        .withColumn("position", F.explode(F.sequence("low", "size")))
    )


def node(length: str) -> Column:
    """The node that the first ``length`` symbols lead to."""
    return F.xxhash64("way", F.expr(f"substring(symbols, 1, {length})"))


def met(at: Column, label: Column) -> Column:
    return F.xxhash64(at, label)


def each_pair_once(pairs: DataFrame) -> DataFrame:
    longer, same = F.length("word") > F.length("other"), F.length("word") == F.length("other")
    return pairs.filter(longer | same & (F.col("word") < F.col("other")))


def near_words(words: DataFrame, longest: int, span: int = 8) -> DataFrame:
    """``word, n, other, other_n`` for every two words one edit apart, each pair once.

    ``words`` holds distinct words with ``n``, of ``longest`` symbols at most.
    ``span`` is the label's length at the first level; the pairs do not depend on it.
    """
    scratch = Scratch(words.sparkSession)
    places = on_tries(words)
    # Of equal symbols side by side the last one, in the order of the word, is passed over for all of them.
    behind = F.when(F.col("way") == 0, part("position + 1", "1")).otherwise(part("position - 1", "1"))
    deleted = F.when(part("position", "1") != behind, F.col("position")).otherwise(-1)
    states = places.filter("position < size").withColumn("key", met(node("position"), part("position + 1", str(span))))
    plain = places.withColumn("key", met(node("position"), part("position", str(span))))

    # Labels that hold the end sign: the edge's word is the neighbour. At most one word for each symbol has the same key.
    ending = states.filter(F.col("size") - F.col("position") <= span).select("key", "word", "n", deleted.alias("deleted"))
    edges = ending.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.lit(None).cast("int").alias("position")).unionByName(
        plain.filter(F.col("size") - F.col("position") < span).select(
            "key", F.col("word").alias("other"), F.col("n").alias("other_n"), "position"))
    replaced = F.col("position").isNull() & (F.col("word") < F.col("other"))
    found = ending.join(edges, "key").filter(replaced | (F.col("deleted") >= F.col("position"))).select("word", "n", "other", "other_n")

    # Longer words go on from the node behind the label, level by level, with labels of twice the length.
    if longest - longest // 2 > span:
        going = states.filter(F.col("size") - F.col("position") > span).select(
            "key", "word", "n", "size", "way", "symbols", part("position", "1").alias("symbol"), deleted.alias("deleted"),
            (F.col("position") + 1 + span).alias("position"))
        wide = states.filter(F.col("size") - F.col("position") > span).select(
            "key", part("position", "1").alias("first"), node(f"position + 1 + {span}").alias("to")).distinct()
        straight = plain.filter(F.col("size") - F.col("position") >= span).select("key", node(f"position + {span}").alias("to")).distinct()
        kept = ["word", "n", "size", "way", "symbols", "position", "to"]
        states = going.join(wide, "key").filter("symbol != first").select(kept).unionByName(
            going.filter("deleted >= 0").join(straight, "key").select(kept))
        reach, length = span, 2 * span
        while True:
            states = scratch.cut(states).withColumn("key", met(F.col("to"), part("position", str(length)))).drop("to")
            edges = places.filter(F.col("position") >= F.col("low") + reach).withColumn("key", met(node("position"), part("position", str(length))))
            last = edges.filter(F.col("size") - F.col("position") < length).select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
            found = found.unionByName(each_pair_once(
                states.filter(F.col("size") - F.col("position") < length).join(last, "key").select("word", "n", "other", "other_n")))
            reach += length
            if reach > longest:
                break
            on = edges.filter(F.col("size") - F.col("position") >= length).select("key", node(f"position + {length}").alias("to")).distinct()
            states = states.filter(F.col("size") - F.col("position") >= length).join(on, "key").withColumn("position", F.col("position") + length).select(kept)
            length *= 2
    return found.filter(F.levenshtein("word", "other") == 1)


def spelling_variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, ratio: int = 10,
    drop_one_in: int | None = None, span: int = 8,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, a row per word.

    Words are the runs of letters of all texts, A-Z in lower case, of
    ``min_length`` symbols and ``min_count`` occurrences (``n``) at least. Two
    words are near when one symbol inserted, deleted or replaced makes them
    equal. The form of a word is its near word of largest ``n`` (ties: the
    smallest), if that ``n`` is at least ``ratio`` times the word's; the root is
    where the forms of forms end, the word itself without one. ``drop_one_in``
    deletes a symbol from one in so many runs, chosen by checksum, to have
    variants to find. Null texts have no words, a null id counts as empty, and
    rows that repeat an id count each. Other columns are not read.
    """
    if ratio < 2 or min_count < 1 or min_length < 2:
        raise ValueError("forms must have larger counts, words two symbols")
    scratch = Scratch(df.sparkSession)
    words = scratch.cut(word_counts(df, id_col, text_col, min_length, min_count, drop_one_in))
    longest, most = words.agg(F.max(F.length("word")), F.max("n")).first()
    near = near_words(words, longest or 0, span)
    both = near.select(F.inline(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), "other")))
    judged = scratch.cut(
        words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n")).unionByName(both)
        .groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
        .withColumn("form_n", F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")))
        .select("word", "n", "n_near", "form_n", F.when(F.col("form_n").isNotNull(), F.col("best.other")).alias("form")))
    # Every form has ``ratio`` times the occurrences, so chains are as short as a logarithm; each round doubles the way.
    steps = max(0, math.floor(math.log(max(1, (most or 1) / min_count), ratio) + 1e-9))
    roots = judged.filter("form is not null").select("word", F.col("form").alias("root"))
    way = 1
    while way < steps:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = scratch.cut(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
        way *= 2
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
