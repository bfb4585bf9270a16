"""Readers and writers of the file formats.

Layouts that hold one document per file are read one file per task, as the
format demands; read them once and keep the rows as parquet with their index.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.functions.text import STEP_LINE, SUMMARY, strip

# Report files that lie beside trajectories.
REPORT_NAMES = ["summary.json", "results.json", "step_index.json", "manifest.json"]

ORDER = "struct<ability:string,progress:double>"
CANDIDATE = (f"struct<tag:bigint,type:string,is_idle:boolean,add_on:string,add_on_tag:bigint,orders:array<{ORDER}>>")
CONTEXT = (f"struct<ability_name:string,selected_tag:bigint,selected_type:string,candidate_executors:array<{CANDIDATE}>,"
           "candidate_count:int,cost_hint:string,pending_actions_summary:string,waiting_actions_summary:string,"
           "executor_conflict_hints:string>")
ACTION = ("struct<seq:int,game_time:double,ability:string,semantic_target:struct<type:string,produces_name:string,"
          "upgrade_name:string>,obs:struct<structured:string,text:string>,local_obs:struct<completed:array<string>,"
          "in_progress:array<string>,pending:array<string>>,place:struct<x:double,y:double,unit_type:string,tag:bigint>,"
          f"executor_context:{CONTEXT}>")
META = ("struct<bot_name:string,opponent_id:string,map:string,map_engine:string,map_localized:string,my_race:string,"
        "enemy_race:string,difficulty:string,result:string,game_duration:double,sequence_count:int,order_list_count:int,"
        "other_abilities_count:int,recorded_at:string>")
TRAJECTORY = f"meta {META}, sequence array<{ACTION}>, order_list array<string>, other_abilities array<string>"
SAMPLE = "system string, conversations array<struct<`from`:string,value:string>>"


def read_trajectories(spark: SparkSession, root: str, *, per_file: bool = True) -> DataFrame:
    """Trajectories below a folder, with their path.

    Report files, unreadable files and objects without sequence or order list
    are left out. A single file named as root is taken without those checks.
    ``per_file=False`` reads compacted files with one trajectory per line.
    """
    single = root.lower().endswith(".json")
    reader = spark.read.schema(TRAJECTORY + ", _corrupt_record string").option("multiLine", per_file).option(
        "recursiveFileLookup", True).option("columnNameOfCorruptRecord", "_corrupt_record")
    if not single:
        reader = reader.option("pathGlobFilter", "*.json")
    rows = reader.json(root).withColumn("path", F.col("_metadata.file_path")).withColumn(
        "_name", F.col("_metadata.file_name"))
    if single:
        return rows.drop("_corrupt_record", "_name")
    good = F.col("_corrupt_record").isNull() & F.col("sequence").isNotNull() & (F.size("order_list") > 0)
    return rows.filter(~F.col("_name").isin(*REPORT_NAMES) & good).drop("_corrupt_record", "_name")


def actions_of(trajectories: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    """One row per recorded action."""
    rows = trajectories.select(*keys, "meta", F.posexplode("sequence").alias("position", "action"))
    return rows.select(*keys, "meta", "position", "action.*")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per line; blank lines and a byte order mark are tolerated."""
    return spark.read.schema(schema).json(path)


def array_rows(texts: DataFrame, keys: Sequence[str] = (), schema: str = SAMPLE) -> DataFrame:
    """Elements of JSON array texts in ``value``, with their position as ``index``."""
    text = F.regexp_replace("value", "^\ufeff", "")
    rows = texts.select(*keys, F.posexplode(F.from_json(text, f"array<struct<{_fields(schema)}>>")).alias("index", "sample"))
    return rows.select(*keys, "index", "sample.*")


def read_sample_array(spark: SparkSession, path: str, schema: str = SAMPLE) -> DataFrame:
    """Elements of a JSON array file with their position as ``index``."""
    return array_rows(spark.read.text(path, wholetext=True), (), schema)


def _fields(schema: str) -> str:
    """Column list of a DDL schema as struct fields."""
    depth, parts, current = 0, [], ""
    for char in schema:
        depth += {"<": 1, ">": -1}.get(char, 0)
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    parts.append(current)
    return ",".join(":".join(part.strip().split(" ", 1)) for part in parts)


def strategy_records(payload: DataFrame) -> DataFrame:
    """Records under ``by_strategy`` (name -> list), else under ``records`` with their own strategy.

    ``payload`` has by_strategy (map) and records (array).
    """
    mapped = payload.filter(F.size("by_strategy") > 0).select(F.explode("by_strategy").alias("strategy", "list"))
    named = mapped.select("strategy", F.explode("list").alias("record"))
    plain = payload.filter(F.coalesce(F.size("by_strategy"), F.lit(0)) <= 0).select(F.explode("records").alias("record"))
    flat = plain.select(F.coalesce("record.strategy", F.lit("")).alias("strategy"), "record")
    return named.unionByName(flat)


def parse_step_lines(lines: DataFrame, keys: Sequence[str], marks: Mapping[str, Column] | None = None) -> DataFrame:
    """Step lines of documents: number and whole line, the last line of a number wins.

    ``lines`` has at (line position) and value. ``marks`` are worked out of ``line``, each line by itself, so that
    who reads those alone carries no texts.
    """
    # The item of an array is worked out once; a filter and what follows would each repeat an expression over the text.
    rows = lines.select(*keys, "at", F.explode(F.array(strip(F.col("value")))).alias("line")).filter(F.rlike("line", F.lit(STEP_LINE)))
    rows = rows.withColumn("number", F.regexp_extract("line", STEP_LINE, 1).cast("int"))
    return rows.groupBy(*keys, "number").agg(
        F.max_by("line", "at").alias("line"), *[F.max_by(c, "at").alias(n) for n, c in (marks or {}).items()])


def read_step_docs(spark: SparkSession, root: str) -> DataFrame:
    """Step lines and summary of markdown documents: path, number, line, summary."""
    docs = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), "value")
    lines = docs.select("path", F.posexplode(F.split("value", "\n")).alias("at", "value"))
    summary = docs.select("path", strip(F.regexp_extract("value", SUMMARY, 1)).alias("summary"))
    return parse_step_lines(lines, ["path"]).join(summary, "path")


RELATION = "struct<relation:string,object_name:string,description:string>"
GRAPH = (f"Ability array<struct<name:string,target:string,tech_chain:array<string>,remaps_to_ability_name:string,"
         f"relations:array<{RELATION}>>>,"
         "Unit array<struct<name:string,race:string,supply:double,minerals:int,gas:int,time:double,is_structure:boolean,"
         f"is_addon:boolean,is_worker:boolean,abilities:array<struct<ability_name:string>>,relations:array<{RELATION}>>>,"
         "Upgrade array<struct<name:string,race:string,cost:struct<minerals:int,gas:int,time:double>,"
         f"relations:array<{RELATION}>>>")


def read_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Ability, unit, upgrade and edge tables of the graph file."""
    data = spark.read.schema(GRAPH).option("multiLine", True).json(path)
    tables = {name: data.select(F.explode(name).alias("row")).select("row.*") for name in ("Ability", "Unit", "Upgrade")}
    kind, result = target_kind(F.col("target")), target_result(F.col("target"))
    tables["Ability"] = tables["Ability"].withColumn("kind", kind).withColumn("result", result)
    edges = None
    for frame in tables.values():
        part = frame.select(F.col("name").alias("subject"), F.explode_outer("relations").alias("r")).select(
            "subject", "r.relation", F.col("r.object_name").alias("object")).filter(F.col("relation").isNotNull())
        edges = part if edges is None else edges.unionByName(part)
    tables["edges"] = edges
    return tables


TARGET = "map<string,struct<produces_name:string,upgrade_name:string>>"


def target_kind(target: Column) -> Column:
    """Kind of a target that is a plain word or an object with one key."""
    return F.coalesce(F.map_keys(F.from_json(target, TARGET))[0], F.regexp_replace(target, '"', ""))


def target_result(target: Column) -> Column:
    value = F.map_values(F.from_json(target, TARGET))[0]
    return F.coalesce(value["produces_name"], value["upgrade_name"])


def read_matches(spark: SparkSession, root: str, names: str = "results.json", lines: bool = False) -> DataFrame:
    """Matches of every ``results.json`` below a folder; with ``lines`` a file holds a run's results on each line."""
    schema = ("matches array<struct<bot_key:string,bot_folder:string,opponent:string,enemy_race:string,difficulty:string,"
              "map:string,port:int,log_path:string,replay_path:string,sequence_dir:string,status:string,result:string,"
              "error:string,sequence_file:string,victory:boolean>>")
    files = spark.read.schema(schema).option("multiLine", not lines).option("recursiveFileLookup", True).option(
        "pathGlobFilter", names).json(root)
    return files.select(F.explode("matches").alias("m")).select("m.*")


def write_dataset(df: DataFrame, path: str, *, append: bool = False, form: str = "json") -> None:
    """Write a dataset folder; ``form`` is json (one object per line) or parquet."""
    df.write.mode("append" if append else "overwrite").format(form).save(path)


def write_manifest(df: DataFrame, path: str, counts: dict[str, Column], parameters: dict[str, str]) -> None:
    """One object of counts and parameters of a run."""
    numbers = df.agg(*[c.alias(n) for n, c in counts.items()])
    fixed = F.struct(*[F.lit(v).alias(n) for n, v in parameters.items()]).alias("parameters")
    numbers.select("*", fixed).write.mode("overwrite").json(path)


# Tasks and modes of the datasets.
TASKS, MODES = ["naming", "ordering", "executor"], ["thinking", "nothink"]


def dataset_registry(datasets: DataFrame) -> DataFrame:
    """Descriptor of each dataset (task, mode): file, format, column and role tags."""
    name = F.concat_ws("_", F.lit("sc2"), "task", F.lit("qwen3"), "mode", F.lit("sft"))
    return datasets.select(
        name.alias("name"), F.concat(name, F.lit(".json")).alias("file_name"), F.lit("sharegpt").alias("formatting"),
        F.struct(F.lit("conversations").alias("messages"), F.lit("system").alias("system")).alias("columns"),
        F.struct(F.lit("from").alias("role_tag"), F.lit("value").alias("content_tag"), F.lit("human").alias("user_tag"),
                 F.lit("gpt").alias("assistant_tag")).alias("tags"))


def merge_existing(old: DataFrame, new: DataFrame, source: str) -> DataFrame:
    """New rows replace all old rows of the same source."""
    return old.join(new.select(source).distinct(), source, "left_anti").unionByName(new)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run's files inside the shared folder."""
    import uuid

    from stepforge.session import shared_folder

    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
