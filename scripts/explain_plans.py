"""Write PLANS.md: the physical plans of the main operators at sf0.1.

    python scripts/explain_plans.py /root/testdata/sf0.1 > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tablewright.functions import hashing  # noqa: E402
from tablewright.operators import changes, columns, keys, runlog  # noqa: E402
from tablewright.plans import registry as r  # noqa: E402
from tablewright.session import local_session, scratch_path, unique_table_name  # noqa: E402
from tablewright.sinks.versioned import VersionedTable, _clustered  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().strip()


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    target, updates = r._merge_inputs(spark, d)
    o = r.table(spark, d, "orders")
    t = VersionedTable.create(spark, unique_table_name("plans"), o, root=scratch_path(spark, "plans"), partition_by=["o_orderstatus"])
    upd = r._orders_partition_updates(spark, d)
    scoped_cond = F.expr("target.o_orderkey = updates.o_orderkey") & (F.col("target.o_orderstatus") == F.col("updates.o_orderstatus"))
    # the write paths store the updates, and the matched rows, before they are used
    stored, _ = t._stored(upd)
    places = ["__tw_dir"]
    touched, _ = t._stored(t._per_dir(t.read(), F.col("o_orderstatus") == "P"))
    cases = [
        ("Conform to a target schema (P2-P5): one projection over the scan, only needed columns read",
         columns.sync_with_table(r.table(spark, d, "customer"), r._sync_target(spark), r.SYNC_ADD, r.SYNC_RENAME, r.SYNC_DROP).processed),
        ("Row hash (F1): JVM-side sha2/concat inside whole-stage codegen",
         hashing.hash_columns(r.table(spark, d, "customer"), "h", 256, "c_custkey", "c_name").select("c_custkey", "h")),
        ("Merge, table scope (M1): LEFT OUTER join + LEFT ANTI join on target keys only",
         changes.merge(target, updates, "target.c_custkey = updates.c_custkey", check_unique=False)),
        ("Merge, partition scope, step 1: matched rows with their new values and partition, computed once and stored",
         changes.merge_parts(t._located(t.read()), stored, None, keys=["o_orderkey"], places=places, check_unique=False).marked
         .filter(F.col(changes.UPDATED) | F.col(changes.DELETED))),
        ("Merge, partition scope, step 2: inserts, found against the target's distinct keys and stored",
         changes.merge_parts(t._located(t.read()), stored, None, keys=["o_orderkey"], places=places, check_unique=False).inserted),
        ("Merge, partition scope, step 3: rows per partition, from partition columns only",
         t._located(t.read()).groupBy("__tw_dir", "o_orderstatus").agg(F.count(F.lit(1)).alias("total"))),
        ("Merge, partition scope, step 4: rows that the updates leave alone, read from the touched partitions (dynamic partition pruning)",
         changes.merge_parts(t._rows_in(t.read(), touched.filter("gone > 0")), stored, None, keys=["o_orderkey"], check_unique=False).marked
         .filter(~(F.col(changes.UPDATED) | F.col(changes.DELETED)))),
        ("Merge, aligned partition scope: target pruned to the partitions present in the updates (J5 + partition filters)",
         changes.merge_parts(keys.prune_target(t._located(t.read()), stored, ["o_orderstatus"]), stored, scoped_cond, places=places,
                             check_unique=False).marked),
        ("Partitioned write: rebalance hint (AQE splits hot partition values)",
         _clustered(o, ["o_orderstatus"])),
        ("Target pruning (J5): per-key semi joins against pre-aggregated distinct values",
         keys.prune_target(o, o.filter("o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')"), ["o_orderstatus", "o_orderpriority"])),
        ("Latest row per key (A4): hash aggregates of the order columns, then max_by over the few rows left",
         runlog.latest_per_key(r.table(spark, d, "events"), ["user_id"], ["ts", "event_id"])),
        ("Delete-then-write on row keys (W10): LEFT ANTI against distinct incoming keys",
         o.join(o.filter("o_orderpriority = '1-URGENT'").select("o_custkey").distinct(), "o_custkey", "left_anti")),
        ("Theta join (J2) with a bounded dimension: broadcast nested loop over 25 nation rows",
         keys.theta_join(r.table(spark, d, "customer"), r.table(spark, d, "nation"), ["c_nationkey >= n_nationkey"], nested_loop=True)),
    ]
    bucketed = VersionedTable.create(spark, unique_table_name("plans_bkt"), target, root=scratch_path(spark, "plans_bkt"),
                                     bucket_by=(8, ["c_custkey"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for an update set too large to broadcast
    bucketed_plan = plan(changes.merge(bucketed.read(), updates, None, keys=["c_custkey"], check_unique=False))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    print("# PLANS\n")
    print(f"Physical plans (`explain()`) of the main operators on `{d}`, Spark 4.1.2, AQE on "
          "(`isFinalPlan=false`: the initial plan, which AQE may still re-plan at runtime). "
          "Generated by `scripts/explain_plans.py`.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")
    print("## Merge into a table bucketed on the key, broadcast disabled: sort-merge joins shuffle only the updates "
          f"(`Bucketed: true` scans, no exchange on the target side)\n\n```\n{bucketed_plan}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
