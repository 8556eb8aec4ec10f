"""Quality reports: one document over sessions, and its summary for people."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.sources import sinks

#: Columns of a session's row; those that a session lacks are null.
SESSION = (
    "session_id string, source_bytes long, video_bytes long, output_bytes long, episodes long, frames long, psnr double, ssim double, aligned boolean, "
    "keyframe_first boolean, tasks long, labels map<string,long>, score double, issues long, valid boolean"
)


def aggregated(sessions: DataFrame) -> dict:
    """Totals, shares and quantiles over all sessions' rows; one row comes to the driver, and a count for each label."""
    share = lambda c: F.avg(F.col(c).cast("int"))
    mb = lambda c: F.round(F.coalesce(F.sum(c), F.lit(0)) / 1e6, 2)
    at = F.percentile("psnr", F.array(F.lit(0.05), F.lit(0.95)))
    r = sessions.agg(
        F.count(F.lit(1)).alias("n"), mb("source_bytes").alias("source"), mb("video_bytes").alias("video"), mb("output_bytes").alias("output"),
        F.round(F.sum("video_bytes") / F.nullif(F.sum("source_bytes"), F.lit(0)), 4).alias("ratio"), F.sum("episodes").alias("episodes"), F.sum("frames").alias("frames"),
        F.round(F.sum("output_bytes") / F.nullif(F.sum("episodes"), F.lit(0)) / 1e3, 1).alias("episode_kb"),
        F.round(F.avg("psnr"), 3).alias("psnr"), F.round(at[0], 3).alias("p5"), F.round(at[1], 3).alias("p95"), F.round(F.avg("ssim"), 4).alias("ssim"),
        F.round(share("aligned"), 4).alias("aligned"), F.round(share("keyframe_first"), 4).alias("keyframe"), F.sum("tasks").alias("tasks"), F.round(F.avg("score"), 4).alias("score"),
        F.count_if("valid").alias("ok"), F.count_if(~F.col("valid")).alias("bad"), F.sum("issues").alias("issues"),
    ).first()
    labels = sessions.select(F.explode("labels").alias("label", "n")).groupBy("label").agg(F.sum("n").alias("n"))
    counts = {x["label"]: x["n"] for x in labels.orderBy(F.desc("n"), "label").collect()}  # a few kinds of action
    total = sum(counts.values())
    return {
        "sessions": r["n"],
        "efficiency": {"source_mb": r["source"], "video_mb": r["video"], "output_mb": r["output"], "compression": r["ratio"], "episodes": r["episodes"] or 0, "frames": r["frames"] or 0, "episode_kb": r["episode_kb"]},
        "video": {"psnr_mean": r["psnr"], "psnr_p5": r["p5"], "psnr_p95": r["p95"], "ssim_mean": r["ssim"], "aligned_rate": r["aligned"], "first_keyframe_rate": r["keyframe"]},
        "annotation": {"tasks": r["tasks"] or 0, "labels": counts, "dominant_label_pct": round(100 * max(counts.values()) / total, 2) if total else 0.0, "score_mean": r["score"]},
        "compliance": {"passed": r["ok"], "failed": r["bad"], "pass_rate": round(r["ok"] / (r["ok"] + r["bad"]), 4) if r["ok"] + r["bad"] else 0.0, "issues": r["issues"] or 0},
    }


def write(sessions: DataFrame, root: str) -> dict:
    """Writes the sessions' rows (SESSION) as JSON lines and the document over them under ``root``, and returns the document."""
    spark = sessions.sparkSession
    kinds = {f.name: f.dataType for f in spark.createDataFrame([], SESSION).schema}
    rows = sessions.select(*[F.col(c).cast(k).alias(c) if c in sessions.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    sinks.write_jsonl(rows, f"{root}/sessions")
    document = {"generated_at": datetime.now(UTC).isoformat(timespec="seconds"), **aggregated(rows)}
    sinks.write_document(document, f"{root}/report", spark)
    return document


def summary(document: dict) -> str:
    """The document as lines to read."""
    lines = [f"sessions: {document['sessions']}   generated: {document.get('generated_at', '')}"]
    if not document["sessions"]:
        return "\n".join([*lines, "no sessions"])
    for part in ("efficiency", "video", "annotation", "compliance"):
        lines += ["", f"[{part}]"]
        for name, value in document[part].items():
            if isinstance(value, dict):
                lines += [f"  {name.replace('_', ' ')}:", *[f"    {k:<12} {n}" for k, n in value.items()]]
            else:
                lines.append(f"  {name.replace('_', ' '):<22} {'-' if value is None else value}")
    return "\n".join(lines)
