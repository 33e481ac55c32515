"""Small canonical records for tests, generated from the record schema."""

from __future__ import annotations

from datetime import datetime, timedelta

from gradeloom.schemas import RECORD_DDL

DDL = f"record_key bigint, file_path string, ingested_at timestamp_ntz, {RECORD_DDL}"

#: criteria of every record, as (id, maximum, given); they add up to 8 and 4
CRITERIA = (("c1", 5.0, 1.5), ("c2", 3.0, 2.5))

#: what differs from an empty value of the type
VALUES = {
    "schema_version": "1.0", "modality": "written", "language": "tr", "grade": 11,
    "task.prompt": "Metni yorumla.", "task.max_score": 8.0,
    "rubric.rubric_id": "rb-1", "rubric.version": "1.0",
    "student_response.text": "Birinci cümle. İkinci cümle!", "student_response.source": "manual",
    "gold_evaluation.total_score": 4.0, "gold_evaluation.max_score": 8.0, "gold_evaluation.needs_review": False, "gold_evaluation.overall_feedback": "İyi.",
    "metadata.status": "teacher_verified", "metadata.created_at": "2025-03-04", "metadata.pii_reviewed": True, "metadata.provenance": "synthetic", "metadata.verification_source": "teacher",
    "metadata.response_quality": "mid_partial", "metadata.adversarial": False, "metadata.review_count": 1, "metadata.adjudicated": False,
    "student_response.input_uncertainties": None,
}


def _fields(ddl: str, sep: str) -> list[tuple[str, str]]:
    """``(name, type)`` of the fields of a DDL string, split at its outer commas."""
    out, depth, at = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            name, kind = ddl[at:i].strip().split(sep, 1)
            out.append((name.strip(), kind.strip()))
            at = i + 1
    return out


def _empty(name: str, kind: str):
    if name in VALUES:
        return VALUES[name]
    if kind.startswith("struct<"):
        return {f: _empty(f"{name}.{f}", k) for f, k in _fields(kind[7:-1], ":")}
    return [] if kind.startswith("array<") else None


def record(key: int, **over) -> dict:
    """A consistent record; ``a__b=value`` replaces the member ``b`` of ``a``."""
    r = {f: _empty(f, k) for f, k in _fields(RECORD_DDL, " ")}
    rid = f"tde11-written-{key:06d}"
    r |= {"record_key": key, "file_path": f"dataset/records/written/{rid}.json", "ingested_at": datetime(2025, 1, 1) + timedelta(seconds=key % 60), "id": rid}
    r["task"]["task_id"] = f"task-{key}"
    r["metadata"] |= {"exam_family": f"ef-{key}", "question_family": f"qf-{key}"}
    for cid, most, given in CRITERIA:
        anchors = [{"score": x, "description": f"{cid} {x:g}"} for x in (0.0, most)] if cid == "c1" else []
        r["rubric"]["criteria"].append({"criterion_id": cid, "name": cid.upper(), "description": f"Ölçüt {cid}", "max_score": most, "scoring_anchors": anchors, "evidence_sources": ["response_text"]})
        r["gold_evaluation"]["criterion_results"].append({"criterion_id": cid, "score": given, "evidence": [], "justification": "j"})
    for path, v in over.items():
        at, *rest = path.split("__")
        if rest:
            r[at][rest[0]] = v
        else:
            r[at] = v
    return r


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)
