"""What keeps time and memory of a query near its input: few exchanges, inputs read once."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from stepforge.plans import battle as B
from stepforge.plans import labels as L
from stepforge.sources.files import parse_step_lines
from stepforge.workload.graph_rows import graph

SF = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_sides_sum_in_one_exchange_without_a_sort(spark):
    rows = [(1, True, "LARGE"), (1, True, "MEDIUM"), (1, False, "PROMO"), (2, False, "ECONOMY"), (2, None, "LARGE"), (3, None, "LARGE"), (4, True, "none")]
    units = spark.createDataFrame(rows, "fight long, mine boolean, type string")
    found = B.sides(units, ["fight"], graph(spark, "unit_values"))
    plan = plan_of(found)
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning(fight") == 1
    vector = {(r.fight, r.mine): r.asDict() for r in B.power_vector(units, ["fight", "mine"], graph(spark, "unit_values")).collect()}
    sides = {r.fight: r.asDict(recursive=True) for r in found.collect()}
    # As in the SQL: a unit of neither side counts for none, and a fight of such units alone is none.
    assert set(sides) == {1, 2}
    for fight, row in sides.items():
        for name, mine in (("own", True), ("enemy", False)):
            wanted = vector.get((fight, mine), {})
            assert row[name] == {f: wanted.get(f, 0) for f in B.POWER_FIELDS}


def test_resampling_reads_its_samples_once(spark):
    """The samples are worked out from the tables once; what checks the rows kept reads them as written."""
    found = E.queries()["resample_invariants"](spark, SF)
    assert not [f for f in found.inputFiles() if SF in f]
    assert found.agg(F.sum("over_cap"), F.sum("left_out")).first()[:2] == (0, 0)


def test_recovered_labels_carry_no_texts(spark):
    """Marks are worked out of the line that wins, give the status alone, and the query joins them as written."""
    found = E.queries()["recover_labels"](spark, SF)
    assert not [f for f in found.inputFiles() if "documents.parquet" in f] and "SortAggregate" not in plan_of(found)
    rows = [(1, 0, f"[Step 1] {L.FAILED_MARK}"), (1, 1, "[Step 1] second"), (1, 2, f"  [Step 3] {L.FAILED_MARK} "), (1, 3, "no step"), (2, 0, None)]
    lines = parse_step_lines(spark.createDataFrame(rows, "traj_id long, at long, value string"), ["traj_id"], {"failed": L.failed_line(F.col("line"))})
    steps = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0)], "traj_id long, step_id long")
    status = ["matched", "skipped_missing_step", "skipped_failed", "skipped_no_document"]
    for given in (lines, lines.drop("line"), lines.drop("failed")):
        out = L.recover_labels(steps, given).orderBy("traj_id", "step_id")
        assert [r.status for r in out.collect()] == status and ("line" in out.columns) == ("line" in given.columns)
