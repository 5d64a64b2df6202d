"""Salted left joins: same rows as the plain join, and no task of a build with gathered ids stands out."""

from __future__ import annotations

import json
import subprocess
import sys
from collections import defaultdict
from pathlib import Path
from statistics import median

from pyspark.sql import functions as F

from entiprof.operators.lookups import JoinStep, join_chain
from entiprof.operators.skew import Skew, heavy_values

ROOT = Path(__file__).resolve().parents[1]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit(11)).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 4 == 0, F.lit("")).otherwise(F.col("id").cast("string")).alias("t"))
    heavy = heavy_values(left, ["k", "t"], 32)
    assert {0, 11} <= set(heavy["k"]) and set(heavy["t"]) == {""} and heavy["k"][0] >= 40
    right = spark.createDataFrame([(0, "zero"), (0, "null again"), (11, "b"), (12, None), (499, "x"), (None, "never")], "k long, v string")
    words = spark.createDataFrame([("", 1), ("", 2), ("17", 3), (None, 4)], "t string, w int")
    steps = lambda salted: [
        JoinStep(right, "r", F.col("l.k") == F.col("r.k"), key=("l.k", "k") if salted else None),
        JoinStep(words, "w", F.col("l.t") == F.col("w.t"), key=("l.t", "t") if salted else None),
        JoinStep(right, "s", F.col("r.k") == F.col("s.k"), key=("r.k", "k") if salted else None),
    ]
    want = ["l.id", "r.v", "w.w", F.col("s.v").alias("sv")]
    plain = join_chain(left, "l", steps(False)).select(*want)
    skew = Skew(["l.id"], {"l.k": heavy["k"], "l.t": heavy["t"], "r.k": heavy["k"]})
    for s in (skew, Skew(["l.id"], {})):
        got = join_chain(left, "l", steps(True), s).select(*want)
        assert got.count() == plain.count() and got.exceptAll(plain).count() == 0
    assert heavy_values(left.limit(0), ["k"], 32) == {"k": {}}


BUILD = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from entiprof.plans import assemble
from entiprof.plans.queries import ROLE_PERIOD_START, _roles
from entiprof.session import build_session
spark = build_session(master="local[4]", **{{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{logs}", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": "file://{shared}",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}})
roles = dict(_roles(spark, "/root/testdata/sf0.1"))
third = F.col("id") % 3 == 0
away = {{"web_id": F.lit(0), "added_by": F.lit(0), "referred_by": F.lit(None), "job_loc_id": F.lit(0), "candidate_profile_id": F.lit(-1)}}
roles["lead"] = roles["lead"].withColumns({{k: F.when(third, v).otherwise(F.col(k)) for k, v in away.items()}})
blank = F.when(F.col("lead_id") % 3 == 0, F.lit("")).otherwise(F.col("job_req_id"))
roles["lead_extra"] = roles["lead_extra"].withColumn("job_req_id", blank)
heavy = assemble.measure_skew(roles) if {salted} else None
spark.sparkContext.setJobDescription("base")
assemble.assemble_base(roles, heavy).select("lead.id", "live.id", "jloc.id", "brand.id", "sstatus.id", "profile.id", "prev.id").write.format("noop").mode("overwrite").save()
spark.sparkContext.setJobDescription("star")
assemble.source_star(roles, heavy=heavy).select("lead.id", "live.id", "jfam.id", "ww.id", "auth.id", "contact.name", "referrer.name", "wtype.name", "ext.ex_source").write.format("noop").mode("overwrite").save()
spark.stop()
"""


def _worst(tmp_path, salted: bool) -> float:
    """The most that a task of a stage read, over what the stage's median task read."""
    logs, shared = tmp_path / f"logs-{salted}", tmp_path / f"shared-{salted}"
    logs.mkdir()
    code = BUILD.format(root=str(ROOT), logs=logs, shared=shared, salted=salted)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=600, capture_output=True)
    read = defaultdict(list)
    (log,) = [f for f in logs.iterdir() if f.is_file()]
    for line in log.read_text().splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            read[e["Stage ID"]].append(e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    stages = [v for v in read.values() if len(v) == 12 and sum(v) > 10_000]
    assert len(stages) > 10
    return max(max(v) / max(1, median(v)) for v in stages)


def test_build_with_a_third_of_the_leads_unmatched(tmp_path):
    assert _worst(tmp_path, salted=True) <= 3 < _worst(tmp_path, salted=False)
