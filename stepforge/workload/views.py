"""Driver tables seen as trajectories, steps, matches, samples, candidates and positions.

Every view exists twice: as a DataFrame and as the SQL that states it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.functions.vocabulary import IMPLIED_ENTITIES
from stepforge.operators.ordered import numbered
from stepforge.workload.graph_rows import ACTIONS, UNIT_VALUE_COLUMNS, UNIT_VALUES, graph_sql, values_sql

STEP_SIZE = 12
HOUR = 3_600_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def hour_of(column: str = "us") -> Column:
    """Block of an hour: the unit that long trajectories are cut into."""
    return F.floor(F.col(column) / F.lit(HOUR))


def text_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def traj_raw(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("user_id").alias("traj_id"), "event_id", micros("ts").alias("us"), "event_type", "value",
        k.alias("k"), F.element_at(text_array(ACTIONS), (k % len(ACTIONS) + 1).cast("int")).alias("ability"),
    )


def traj(spark: SparkSession, sf: str) -> DataFrame:
    return numbered(traj_raw(spark, sf), ["traj_id"], ["us", "event_id"], hour_of())


def step(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectory rows cut into steps of at most ``STEP_SIZE`` actions."""
    return traj(spark, sf).withColumn("step_id", F.floor(F.col("seq") / STEP_SIZE))


def match(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    races = text_array(["Terran", "Zerg", "Protoss"])
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("match_id"), F.col("c_mktsegment").alias("bot"),
        F.col("o_orderpriority").alias("difficulty"),
        F.element_at(races, (F.col("o_orderkey") % 3 + 1).cast("int")).alias("race"),
        (F.col("o_orderstatus") == "F").alias("victory"),
        F.col("o_totalprice").alias("duration"), F.col("c_custkey").alias("opponent"),
    )


def sample(spark: SparkSession, sf: str) -> DataFrame:
    """One row per conversation: first system, user and assistant text."""
    turns = table(spark, sf, "conversations")

    def first(role):
        return F.min_by("text", F.when(F.col("role") == role, F.col("turn")))

    return turns.groupBy("conv_id").agg(
        first("system").alias("system"), first("user").alias("user"),
        first("assistant").alias("answer"), F.count(F.lit(1)).alias("turns"),
    )


def cand(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as candidates for an order's prompt."""
    kinds = {"A": "BARRACKS", "N": "COMMANDCENTER", "R": "ORBITALCOMMAND"}
    unit = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[F.col("l_returnflag")]
    tax = F.round(F.col("l_tax") * 100).cast("int")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("prompt"), F.col("l_suppkey").alias("tag"),
        F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), unit.alias("unit"),
        (F.col("l_linestatus") == "O").alias("is_idle"),
        F.round(F.col("l_discount") * 10, 1).alias("progress"),
        F.when(tax >= 6, "reactor").when(tax >= 4, "techlab").when(tax >= 3, "other").otherwise("none").alias("addon"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )


def cand_lists(spark: SparkSession, sf: str, *columns: Column) -> DataFrame:
    """A prompt's candidates, an order's lines, all of them, as one list ``l`` in their order.

    Whoever writes a prompt holds its list; the list is sorted after one exchange, its rows need no numbers.
    """
    entry = F.struct("line", "part", "tag", "quantity", "price", *columns)
    return cand(spark, sf).groupBy("prompt").agg(F.array_sort(F.collect_list(entry)).alias("l"))


def pos(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf, "part").select(
        key.alias("tag"), (key * 37 % 200 + size * 0.25).alias("x"), (key * 53 % 200 + (size * 7 % 20) * 0.25).alias("y"),
        F.col("p_type").alias("type"),
        F.col("p_size").cast("bigint").alias("size"), F.col("p_retailprice").alias("price"),
    )


def units(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as units of a game: the supplier is the game, the line status the side."""
    lines, parts = table(spark, sf, "lineitem"), pos(spark, sf)
    return lines.join(parts, lines.l_partkey == parts.tag).select(
        F.col("l_suppkey").alias("game"), F.col("l_orderkey").alias("tag"), "type",
        (F.col("l_linestatus") == "O").alias("mine"), F.round(F.col("l_discount") * 10, 1).alias("progress"),
        F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("bigint").alias("assigned"),
        F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_extendedprice").alias("price"), "x", "y", "size",
        micros("l_shipdate").alias("us"),
    )


def audit(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as audited samples."""
    labels, documents = table(spark, sf, "labels"), table(spark, sf, "documents")
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("index"), (F.col("quality") == 1).alias("passed"),
        (F.col("toxic") == 1).alias("dropped"), "text", "lang", "source", "n_chars",
    )


SQL_VIEWS: dict[str, tuple[list[str], str]] = {
    "ability": ([], graph_sql("ability")),
    "executor": ([], graph_sql("executor")),
    "entity": ([], graph_sql("entity")),
    "implied": ([], values_sql(["entity", "implied"], IMPLIED_ENTITIES)),
    "traj": ([], f"""
        SELECT user_id AS traj_id, event_id, epoch_us(ts) AS us, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               ({sql_list(ACTIONS)})[CAST(json_extract_string(props, '$.k') AS BIGINT) % {len(ACTIONS)} + 1] AS ability,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq
        FROM events"""),
    "step": (["traj"], f"SELECT *, seq // {STEP_SIZE} AS step_id FROM traj"),
    "match": ([], """
        SELECT o_orderkey AS match_id, c_mktsegment AS bot, o_orderpriority AS difficulty,
               (['Terran', 'Zerg', 'Protoss'])[o_orderkey % 3 + 1] AS race, o_orderstatus = 'F' AS victory,
               o_totalprice AS duration, c_custkey AS opponent
        FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "sample": ([], """
        SELECT conv_id, arg_min(text, turn) FILTER (role = 'system') AS system,
               arg_min(text, turn) FILTER (role = 'user') AS user_text,
               arg_min(text, turn) FILTER (role = 'assistant') AS answer, count(*) AS turns
        FROM conversations GROUP BY conv_id"""),
    "cand": ([], """
        SELECT l_orderkey AS prompt, l_suppkey AS tag, l_linenumber AS line, l_partkey AS part,
               CASE l_returnflag WHEN 'A' THEN 'BARRACKS' WHEN 'N' THEN 'COMMANDCENTER'
                    ELSE 'ORBITALCOMMAND' END AS unit,
               l_linestatus = 'O' AS is_idle, round(l_discount * 10, 1) AS progress,
               CASE WHEN round(l_tax * 100) >= 6 THEN 'reactor' WHEN round(l_tax * 100) >= 4 THEN 'techlab'
                    WHEN round(l_tax * 100) >= 3 THEN 'other' ELSE 'none' END AS addon,
               l_quantity AS quantity, l_extendedprice AS price
        FROM lineitem"""),
    "cand_list": (["cand"], """
        SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY line, part, tag, quantity, price) - 1 AS place FROM cand"""),
    "pos": ([], """
        SELECT p_partkey AS tag, CAST(p_partkey * 37 % 200 + p_size * 0.25 AS DOUBLE) AS x,
               CAST(p_partkey * 53 % 200 + (p_size * 7 % 20) * 0.25 AS DOUBLE) AS y, p_type AS type,
               CAST(p_size AS BIGINT) AS size, p_retailprice AS price
        FROM part"""),
    "units": (["pos"], """
        SELECT l_suppkey AS game, l_orderkey AS tag, type, l_linestatus = 'O' AS mine,
               round(l_discount * 10, 1) AS progress, l_returnflag AS flag, CAST(l_quantity AS BIGINT) AS assigned,
               CAST(l_linenumber AS BIGINT) AS line, l_extendedprice AS price, x, y, size, epoch_us(l_shipdate) AS us
        FROM lineitem JOIN pos ON l_partkey = tag"""),
    "unit_values": ([], values_sql(UNIT_VALUE_COLUMNS, UNIT_VALUES)),
    "audit": ([], """
        SELECT doc_id AS index, quality = 1 AS passed, toxic = 1 AS dropped, text, lang, source, n_chars
        FROM labels JOIN documents USING (doc_id)"""),
}


def with_views(names: list[str], body: str) -> str:
    """The query with the views it reads in front, dependencies first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in SQL_VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    head = ",\n".join(f"{name} AS ({SQL_VIEWS[name][1]})" for name in ordered)
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        # The body's own common tables follow the views.
        rest = stripped[5:].lstrip()
        if rest.upper().startswith("RECURSIVE "):
            rest = rest[10:]
        return f"WITH RECURSIVE {head},\n{rest}"
    return f"WITH RECURSIVE {head}\n{body}"
