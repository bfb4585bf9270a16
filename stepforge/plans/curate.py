"""Coverage of answer classes, deduplication, caps and matching of checked reasoning."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepforge.operators.keyed import first_per_key, top_per_key
from stepforge.operators.ordered import numbered


def class_coverage(sources: Sequence[DataFrame]) -> DataFrame:
    """Distinct prompts with reasoning per class over all sources (class, prompt)."""
    rows = sources[0]
    for other in sources[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("class").agg(F.countDistinct("prompt").alias("cot"))


def coverage_stats(pending: DataFrame, covered: DataFrame, sparse_max: int) -> DataFrame:
    """Pending distinct prompts per class against those with reasoning.

    A prompt that occurs with several classes counts for the one it came with last.
    """
    last = first_per_key(pending.select("prompt", "class", "index"), ["prompt"], [F.col("index")], latest=True)
    stats = last.groupBy("class").agg(F.count(F.lit(1)).alias("pending")).join(covered, "class", "left")
    cot = F.coalesce("cot", F.lit(0))
    return stats.select("class", "pending", cot.alias("cot"), F.when(cot == 0, "none").when(
        cot <= sparse_max, "sparse").otherwise("ok").alias("coverage"))


def target_count(pending: Column, least: int) -> Column:
    return F.least(pending, F.lit(least))


def below_target(samples: DataFrame, covered: DataFrame, least: int) -> DataFrame:
    """Samples of classes that have less reasoning than their target."""
    pending = samples.groupBy("class").agg(F.count(F.lit(1)).alias("pending"))
    short = pending.join(covered, "class", "left").withColumn("cot", F.coalesce("cot", F.lit(0))).withColumn(
        "target", target_count(F.col("pending"), least)).filter(F.col("cot") < F.col("target"))
    return samples.join(short, "class")


def subset_index(rows: DataFrame, index: str, block: int, name: str = "subset_index") -> DataFrame:
    """Dense positions of the rows in the order of their old index, numbered per range of it."""
    return numbered(rows, [], [index], F.floor(F.col(index) / block), name)


def dedupe_prompt(rows: DataFrame, rank: Column, order: str) -> DataFrame:
    """One row per prompt: lowest model rank, first loaded wins ties."""
    return first_per_key(rows, ["prompt"], [rank, F.col(order)])


def cap_per_class(rows: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows per class, last-step sources before others, then by prompt."""
    return top_per_key(rows, ["class"], [F.when(F.col("source").startswith("laststep"), 0).otherwise(1), F.col("prompt")], n)


def cap_stats(rows: DataFrame, n: int) -> DataFrame:
    counted = rows.groupBy("class").agg(F.count(F.lit(1)).alias("available"))
    selected = F.least("available", F.lit(n))
    return counted.withColumn("selected", selected).withColumn("capped", F.col("available") > n).withColumn(
        "under_target", F.col("selected") < n)


def one_per_reasoning(rejects: DataFrame, key: str, reasoning: str, order: str, start: int | None = None) -> DataFrame:
    """The first reject per gold answer and reasoning, or per its first ``start`` characters if given."""
    said = F.col(reasoning) if start is None else F.substring(reasoning, 1, start)
    return first_per_key(rejects.withColumn("_said", said), [key, "_said"], [F.col(order)]).drop("_said")


def rank_allocate(passing: DataFrame, samples: DataFrame, block_rows: Column, block_samples: Column,
                  order: Sequence[str]) -> DataFrame:
    """The n-th passing row of a gold key takes the n-th sample index of that key."""
    left = numbered(passing, ["key"], order, block_rows, "_n")
    right = numbered(samples, ["key"], ["index"], block_samples, "_n").select("key", "_n", "index")
    return left.join(right, ["key", "_n"]).drop("_n")


def class_gate(rows: DataFrame, existing: DataFrame, least: int, order: Sequence[Column]) -> DataFrame:
    """Passing rows admitted until a class has its target, counting what exists.

    No class admits more than ``least`` rows, so each task first cuts its rows
    of a class to that many.
    """
    pending = rows.groupBy("class").agg(F.count(F.lit(1)).alias("pending"))
    room = pending.join(existing, "class", "left").select("class", (target_count(F.col("pending"), least) - F.coalesce(
        "existing", F.lit(0))).alias("room"))
    first = top_per_key(rows.filter("passed"), ["class"], order, least)
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    few = first.groupBy("class").agg(F.array_sort(F.collect_list(F.struct(at.alias("at"), "index"))).alias("l")).join(room, "class")
    kept = few.filter(F.col("room") > 0).select("class", F.explode(F.slice("l", F.lit(1), F.col("room").cast("int"))).alias("e"))
    return kept.select("class", F.col("e.index").alias("index"))


def recover(rejects: DataFrame, audited: DataFrame) -> DataFrame:
    """Rejected rows whose rules pass now, first success per index; ``rejects`` has stage, reasons, order."""
    fresh = rejects.filter(F.col("stage") == "rule_check").join(audited.select("index"), "index", "left_anti")
    return first_per_key(fresh.filter(F.size("reasons") == 0), ["index"], [F.col("order")])


def rebuild(audits: DataFrame, samples: DataFrame) -> DataFrame:
    """Audited final answers put into their samples; missing answers and unknown indices fall out."""
    final = audits.filter(F.col("final").isNotNull()).select("index", "final")
    return samples.join(final, "index")


def tagged_union(sources: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows with reasoning of every source, tagged with source and model."""
    out = None
    for frame, source, model in sources:
        rows = frame.filter(F.coalesce(F.col("cot"), F.lit("")) != "").withColumn(
            "source", F.lit(source)).withColumn("model", F.lit(model))
        out = rows if out is None else out.unionByName(rows)
    return out


MODEL_RANK = {"4b": 0, "14b": 1, "32b": 2}


def model_order(model: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in MODEL_RANK.items() for x in pair])[model]


def ranged(rank: str, key: str, width: int = 65536) -> Column:
    """Block of rows ordered by a small rank and then a number."""
    return F.col(rank).cast("bigint") * (1 << 40) + F.floor(F.col(key) / width)


def round_robin(rows: DataFrame, bot: str, order: Sequence[str], block: Column) -> DataFrame:
    """Turn of each game in its bot's own order; games are then taken turn by turn."""
    return numbered(rows, [bot], order, block, "turn")


def greedy_turns(counts: Mapping[tuple[Any, Any, Any], int]) -> list[tuple]:
    """The order in which bots take turns to pick games, as runs over the counts of (bot, hard, race).

    Round after round every bot in order picks a game of its hardest difficulty
    left, of the race picked least so far by all bots together (ties: the
    smaller race). A run ``(bot, hard, race, nth, step, turn, every, times)``
    says that the bucket's games ``nth``, ``nth + step``, ... are picked in rounds
    ``turn``, ``turn + every``, ... Rounds that pick alike, or rounds that come
    back to the same gaps between races, are skipped over at once, so the
    work follows the buckets and not the games.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    bots = sorted({k[0] for k in left})
    picked = dict.fromkeys(sorted({k[2] for k in left}), 0)
    taken, runs, turn, seen, last = dict.fromkeys(left, 0), [], 0, {}, None

    def one_round():
        """The buckets picked in this round, with what the race counts then were."""
        now, out = dict(picked), []
        for bot in bots:
            open_ = [k for k in left if k[0] == bot and left[k] > taken[k]]
            if open_:
                hard = min(k[1] for k in open_)
                fitting = [k for k in open_ if k[1] == hard]
                best = min(fitting, key=lambda k: (now[k[2]], k[2]))
                out.append((best, fitting, dict(now)))
                now[best[2]] += 1
        return out

    def advance(rounds, times):
        """Record the picks of a list of rounds repeated ``times`` times."""
        nonlocal turn
        used = Counter(k for picks in rounds for k in picks)
        done: Counter = Counter()
        for at, picks in enumerate(rounds):
            for k in picks:
                runs.append((*k, taken[k] + done[k], used[k], turn + at, len(rounds), times))
                done[k] += 1
        for k, n in used.items():
            taken[k] += n * times
            picked[k[2]] += n * times
        turn += len(rounds) * times

    history: list[list] = []
    while True:
        picks = one_round()
        if not picks:
            return runs
        chosen = [k for k, _, _ in picks]
        gained = Counter(k[2] for k in chosen)
        # The same picks hold for as long as no bucket ends and no race falls behind another that the bot could pick.
        times = min(left[k] - taken[k] for k in chosen)
        for k, fitting, now in picks:
            for other in fitting:
                gap, closing = now[other[2]] - now[k[2]], gained[k[2]] - gained[other[2]]
                if closing > 0:
                    times = min(times, (gap - (k[2] > other[2])) // closing + 1)
        state = (tuple(n - min(picked.values()) for n in picked.values()), tuple(left[k] > taken[k] for k in left))
        if times > 1:
            history, seen = [], {}
            advance([chosen], times)
            continue
        if state in seen:
            rounds = history[seen[state]:]
            used = Counter(k for one in rounds for k in one)
            again = min((left[k] - taken[k] - 1) // n for k, n in used.items())
            history, seen = [], {}
            if again > 0:
                advance(rounds, again)
                continue
        seen[state] = len(history)
        history.append(chosen)
        advance([chosen], 1)


def diverse_order(rows: DataFrame, bot: str) -> DataFrame:
    """Add ``turn``: bots pick in turns, hardest first, of the race picked least by all of them so far.

    ``rows`` has hard, race and match_id. Only the number of games of each
    (bot, hard, race) is brought to the driver, a table of fixed vocabularies;
    games come in order of match_id inside it.
    """
    counts = {(r[0], r[1], r[2]): r[3] for r in rows.groupBy(bot, "hard", "race").agg(F.count(F.lit(1)).alias("n")).collect()}
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in (bot, "hard", "race"))
    runs = rows.sparkSession.createDataFrame(
        greedy_turns(counts), f"{kinds}, _first bigint, _step bigint, _turn bigint, _every bigint, _times bigint")
    placed = numbered(rows, [bot, "hard", "race"], ["match_id"], F.floor(F.col("match_id") / 65536), "_nth")
    ahead = F.col("_nth") - F.col("_first")
    met = placed.join(runs, [bot, "hard", "race"]).filter((ahead >= 0) & (ahead % F.col("_step") == 0) & (ahead < F.col("_step") * F.col("_times")))
    turn = F.col("_turn") + (ahead / F.col("_step")).cast("bigint") * F.col("_every")
    return met.select(*rows.columns, turn.alias("turn"))
