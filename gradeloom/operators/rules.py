"""Declarative rules: each is a level, a code, a predicate and what it found.

All rules of a set are evaluated in one narrow pass: ``array(when(p, struct))``,
nulls removed, exploded.  Findings have the columns ``(key, level, code, detail)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, is_true, number_g
from ..schemas import EVALUATION_SPLITS, HARD_CASE_TYPES, MODALITIES, NONTEXT_EVIDENCE, PREDICTION_SCHEMA, QUALITY_LEVELS, RUBRIC_SCHEMA, TOLERANCE, VERIFIED_STATUSES
from ..storage import materialize
from .skew import hot_keys, join_unique


@dataclass(frozen=True)
class Rule:
    code: str
    level: str
    when: Column
    detail: Column | None = None
    #: a rule that can fire several times gives an array of details instead
    many: Column | None = None


def apply_rules(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """``(key, level, code, detail)`` for every rule that fires; a null predicate does not fire."""
    single = [
        F.when(r.when, F.struct(F.lit(r.level).alias("level"), F.lit(r.code).alias("code"), (r.detail if r.detail is not None else F.lit(None)).cast("string").alias("detail")))
        for r in rules
        if r.many is None
    ]
    found = F.array_compact(F.array(*single)) if single else None
    for r in rules:
        if r.many is not None:
            found = _append(found, r)
    return df.select(key, F.explode(found).alias("f")).select(key, "f.level", "f.code", "f.detail")


def _append(found: Column | None, r: Rule) -> Column:
    part = F.transform(r.many, lambda d: F.struct(F.lit(r.level).alias("level"), F.lit(r.code).alias("code"), d.cast("string").alias("detail")))
    part = F.coalesce(F.when(r.when, part), F.array().cast("array<struct<level:string,code:string,detail:string>>"))
    return part if found is None else F.concat(found, part)


def _list(c: Column) -> Column:
    return F.filter(c, lambda x: x.isNotNull())


def _ids(path: str) -> Column:
    return F.transform(_list(F.col(path)), lambda x: x["criterion_id"])


def _total(path: str, field: str) -> Column:
    return F.aggregate(F.transform(_list(F.col(path)), lambda x: F.coalesce(x[field], F.lit(0.0))), F.lit(0.0), lambda a, b: a + b)


def _differs(a: Column, b: Column) -> Column:
    return F.abs(a - b) > TOLERANCE


CRITERIA, RESULTS = "rubric.criteria", "gold_evaluation.criterion_results"

# Signs of personal data, as (name, pattern), in the order of their names, which pii_signs keeps.
PII_SIGNS = (
    ("email", r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"),
    ("okul_numarasi_etiketi", r"(?iU)\b(?:okul|öğrenci)\s*(?:no|numara|numarası)\b"),
    ("tc_kimlik_etiketi", r"(?iU)\b(?:T\.?\s*C\.?\s*)?(?:kimlik|kimlik\s*no|tc\s*no)\b"),
    ("telefon", r"(?U)(?<!\d)(?:\+?90\s*)?(?:0?\s*)?5\d{2}[\s.-]?\d{3}[\s.-]?\d{2}[\s.-]?\d{2}(?!\d)"),
)


def all_strings() -> Column:
    """Every string of a canonical record, one per line (a newline matches no sign)."""
    crit, res, meta, task, resp, gold = F.col(CRITERIA), F.col(RESULTS), F.col("metadata"), F.col("task"), F.col("student_response"), F.col("gold_evaluation")
    join = lambda a: F.array_join(a, "\n")
    scalars = [F.col(c) for c in ("id", "schema_version", "modality", "language")]
    scalars += [task[c] for c in ("task_id", "prompt", "context")] + [F.col("rubric.rubric_id"), F.col("rubric.version"), resp["text"], resp["source"]]
    scalars += [gold[c] for c in ("review_reason", "overall_feedback")]
    scalars += [meta[c] for c in ("status", "split", "created_at", "subject_group_id", "exam_family", "question_family", "provenance", "verification_source", "response_quality")]
    lists = [join(meta["tags"]), join(meta["hard_case_types"])]
    lists.append(join(F.transform(_list(crit), lambda c: F.concat_ws("\n", c["criterion_id"], c["name"], c["description"], F.array_join(F.transform(_list(c["scoring_anchors"]), lambda a: a["description"]), "\n"), F.array_join(c["evidence_sources"], "\n")))))
    lists.append(join(F.transform(_list(res), lambda r: F.concat_ws("\n", r["criterion_id"], F.array_join(r["evidence"], "\n"), r["justification"]))))
    lists.append(join(F.transform(_list(resp["observations"]), lambda o: F.concat_ws("\n", o["label"], o["value"], o["source"]))))
    lists.append(join(F.transform(_list(resp["input_uncertainties"]), lambda u: F.concat_ws("\n", u["span"], F.array_join(u["candidates"], "\n")))))
    return F.concat_ws("\n", *scalars, *lists)


def pii_signs(text: Column) -> Column:
    """Sorted names of the signs found in a text."""
    # what a sign cannot do without is looked for first: far cheaper than the pattern, with the same result
    needs = {"email": F.contains(text, F.lit("@")), "telefon": text.rlike(r"5[0-9\p{Nd}]{2}")}
    return F.array_compact(F.array(*[F.when(needs.get(n, F.lit(True)) & text.rlike(p), F.lit(n)) for n, p in PII_SIGNS]))


def record_rules(path: str | None = "file_path") -> list[Rule]:
    """Consistency of one record."""
    c, r = F.col(CRITERIA), F.col(RESULTS)
    cids, rids = _ids(CRITERIA), _ids(RESULTS)
    has_c, has_r = F.size(_list(c)) > 0, F.size(_list(r)) > 0
    missing, extra = F.array_sort(F.array_except(cids, rids)), F.array_sort(F.array_except(rids, cids))
    task_max, gold_max, total = F.col("task.max_score"), F.col("gold_evaluation.max_score"), F.col("gold_evaluation.total_score")
    # the last criterion of an id counts, as in a dictionary
    limit = lambda x: F.element_at(F.transform(F.filter(_list(c), lambda k: k["criterion_id"] == x["criterion_id"]), lambda k: k["max_score"]), -1)
    over = F.filter(_list(r), lambda x: F.size(F.filter(_list(c), lambda k: k["criterion_id"] == x["criterion_id"])) > 0)
    over = F.filter(over, lambda x: x["score"] > limit(x) + TOLERANCE)
    nontext = F.filter(_list(c), lambda k: F.arrays_overlap(k["evidence_sources"], F.array(*[F.lit(x) for x in NONTEXT_EVIDENCE])))
    review, reason = F.col("gold_evaluation.needs_review"), F.col("gold_evaluation.review_reason")
    # one element or none; through an array, so that the long text is put together once
    signs = F.filter(F.transform(F.array(all_strings()), lambda t: F.array_join(pii_signs(t), ", ")), lambda x: x != "")
    rules = [
        Rule("duplicate_criterion_id", "error", F.size(cids) != F.size(F.array_distinct(cids))),
        Rule("duplicate_result_id", "error", F.size(rids) != F.size(F.array_distinct(rids))),
        Rule("criterion_result_mismatch", "error", has_c & has_r & ((F.size(missing) > 0) | (F.size(extra) > 0)), F.concat(F.lit("missing="), F.array_join(missing, ","), F.lit(" extra="), F.array_join(extra, ","))),
        Rule("criterion_score_overflow", "error", has_r, many=F.transform(over, lambda x: F.concat(x["criterion_id"], F.lit(": "), number_g(x["score"])))),
        Rule("rubric_task_max_mismatch", "error", has_c & _differs(_total(CRITERIA, "max_score"), task_max)),
        Rule("task_gold_max_mismatch", "error", _differs(task_max, gold_max)),
        Rule("total_score_mismatch", "error", has_r & _differs(_total(RESULTS, "score"), total)),
        Rule("total_score_overflow", "error", total > gold_max + TOLERANCE),
        Rule("review_reason_required", "error", is_true(review) & blank(reason)),
        Rule("unexpected_review_reason", "warning", (review == F.lit(False)) & ~blank(reason)),
        Rule("verified_without_pii_review", "error", (F.col("metadata.status") == "teacher_verified") & ~is_true(F.col("metadata.pii_reviewed"))),
        Rule("possible_pii", "warning", F.lit(True), many=signs),
        Rule("missing_nontext_observation", "warning", F.coalesce(F.size("student_response.observations"), F.lit(-1)) <= 0, many=F.coalesce(F.transform(nontext, lambda k: k["criterion_id"]), F.array().cast("array<string>"))),
    ]
    if path:
        p = F.col(path)
        stem = F.regexp_extract(p, r"([^/]+?)(?:\.[^./]*)?$", 1)
        folder = F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)
        rules += [
            Rule("filename_id_mismatch", "error", stem != F.col("id"), stem),
            Rule("modality_folder_mismatch", "error", F.col("modality").isin(*MODALITIES) & (folder != F.col("modality")), folder),
        ]
    return rules


def duplicate_ids(df: DataFrame, key: str, id_col: str = "id", path: str = "file_path") -> DataFrame:
    """A finding on every later path of an id, naming the first one (ties by ``key``).

    The first path is a minimum, combined before the shuffle and joined back with hot ids
    salted, so an id on a third of all rows is in no task by itself.  Null ids are no
    duplicates of each other; a null path comes first.
    """
    at = F.struct(F.col(path).alias("p"), F.col(key).alias("k"))
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), at.alias("at"))
    first = materialize(rows.groupBy("__id").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1"), "first-paths")
    hot = hot_keys(first, "__id", "n", first.agg(F.sum("n")).first()[0] or 0)
    later = join_unique(rows, first, "__id", hot, F.xxhash64("at")).where("at != first")
    return later.select(F.col("at.k").alias(key), F.lit("error").alias("level"), F.lit("duplicate_record_id").alias("code"), F.col("first.p").alias("detail"))


def policy_rules(min_reviews: int = 1, eval_reviews: int = 2, borderline_reviews: int = 2, review_reviews: int = 2) -> list[Rule]:
    """Policy for verified records (others are to be filtered out before)."""
    m, status = F.col("metadata"), F.col("metadata.status")
    quality, hard, adv, rc = m["response_quality"], m["hard_case_types"], m["adversarial"], m["review_count"]
    reviews, labels, flag = F.coalesce(rc, F.lit(0)), F.coalesce(hard, F.array().cast("array<string>")), is_true(adv)
    review = is_true(F.col("gold_evaluation.needs_review"))
    invalid = F.array_sort(F.array_except(F.array_distinct(labels), F.array(*[F.lit(x) for x in HARD_CASE_TYPES])))
    expected = F.when(status == "ai_verified", "ai").otherwise("teacher")
    ambiguous = F.array(F.lit("missing_evidence"), F.lit("rubric_ambiguity"))
    return [
        Rule("verification_source_mismatch", "error", ~expected.eqNullSafe(m["verification_source"]), m["verification_source"]),
        Rule("production_task_id_required", "error", blank(F.col("task.task_id"))),
        Rule("response_quality_required", "error", ~F.coalesce(quality.isin(*QUALITY_LEVELS), F.lit(False)), quality),
        Rule("hard_case_types_required", "error", hard.isNull()),
        Rule("invalid_hard_case_type", "error", F.size(invalid) > 0, F.array_join(invalid, ", ")),
        Rule("adversarial_required", "error", adv.isNull()),
        Rule("review_count_required", "error", rc.isNull()),
        Rule("insufficient_review_count", "error", rc < min_reviews),
        Rule("adjudicated_required", "error", m["adjudicated"].isNull()),
        Rule("evaluation_split_requires_dual_review", "error", m["split"].isin(*EVALUATION_SPLITS) & (reviews < eval_reviews), m["split"]),
        Rule("borderline_requires_dual_review", "error", (quality == "borderline") & (reviews < borderline_reviews)),
        Rule("needs_review_requires_dual_review", "error", review & (reviews < review_reviews)),
        Rule("adversarial_without_hard_case", "warning", flag & (F.size(labels) == 0)),
        Rule("prompt_injection_must_be_adversarial", "error", F.array_contains(labels, "prompt_injection") & ~flag),
        Rule("ambiguity_without_review_target", "warning", F.arrays_overlap(labels, ambiguous) & ~review),
    ]


def verified_status(df: DataFrame) -> DataFrame:
    return df.where(F.col("metadata.status").isin(*VERIFIED_STATUSES))


def leakage_findings(found: DataFrame) -> DataFrame:
    """Leaking link values as findings without a record."""
    return found.select(F.lit(None).cast("bigint").alias("record_key"), F.lit("error").alias("level"), F.lit("split_leakage").alias("code"), F.format_string("%s='%s' in %s", "field", "value", "splits").alias("detail"))


def render(findings: DataFrame, path: str | None = None) -> DataFrame:
    """``LEVEL   code: detail [path]`` as one text column."""
    where = F.coalesce(F.concat(F.lit(" ["), F.col(path), F.lit("]")), F.lit("")) if path else F.lit("")
    return findings.select(F.concat(F.rpad(F.upper("level"), 7, " "), F.lit(" "), F.col("code"), F.lit(": "), F.coalesce("detail", F.lit("")), where).alias("line"))


# ---- grounding of texts ----------------------------------------------------------------
# Words that describe the capture of an answer and must not stand in it.
DIAGNOSTIC_PROSE = ("Transkriptte", "transkriptimde", "OCR’da", "OCR'da", "taranan cevabımda")


def ungrounded_evidence(records: DataFrame, key: str) -> DataFrame:
    """``(key, criterion_id)`` of results with evidence that stands word for word in neither answer nor observations.

    Null evidence counts for nothing; the mark of a clipped text is ignored.
    """
    strip = lambda e: F.regexp_replace(e, "…$", "")
    seen = F.array_join(F.transform(F.filter(_list(F.col("student_response.observations")), lambda o: o.isNotNull()), lambda o: o["value"]), "\n")
    text = F.concat_ws("\n", F.col("student_response.text"), F.nullif(seen, F.lit("")))
    r = records.select(key, text.alias("t"), F.explode("gold_evaluation.criterion_results").alias("r"))
    return r.where(F.exists("r.evidence", lambda e: ~F.contains("t", strip(e)))).select(key, F.col("r.criterion_id").alias("criterion_id"))


def ungrounded_uncertainties(records: DataFrame, key: str) -> DataFrame:
    """``(key, span)`` of uncertain spans that are not in the text or have fewer than two candidates."""
    r = records.select(key, F.lower("student_response.text").alias("t"), F.explode("student_response.input_uncertainties").alias("u")).where("u is not null")
    bad = ~F.coalesce(F.contains("t", F.lower("u.span")), F.lit(False)) | (F.coalesce(F.size("u.candidates"), F.lit(0)) < 2)
    return r.where(bad).select(key, F.col("u.span").alias("span"))


def diagnostic_prose(records: DataFrame, key: str) -> DataFrame:
    """Keys of records whose answer talks about its own capture."""
    return records.where(F.col("student_response.text").rlike("|".join(DIAGNOSTIC_PROSE))).select(key)


# ---- typed checks on raw JSON ----------------------------------------------------------
#: What each checked path must be, as a VARIANT type.
TYPED_PATHS = {
    "$.grade": "BIGINT",
    "$.task.max_score": "number",
    "$.rubric.criteria": "ARRAY",
    "$.gold_evaluation.criterion_results": "ARRAY",
    "$.metadata.hard_case_types": "ARRAY",
    "$.metadata.pii_reviewed": "BOOLEAN",
}


def type_findings(df: DataFrame, key: str, payload: str, paths: dict[str, str] | None = None) -> DataFrame:
    """Wrong or missing types in JSON text, told apart from nulls by VARIANT type tags.

    Unreadable text gives one ``invalid_json`` finding and no others.
    """
    v = df.select(key, F.try_parse_json(F.col(payload)).alias("v"))
    rules = [Rule("invalid_json", "error", F.col("v").isNull())]
    for path, want in (paths or TYPED_PATHS).items():
        tag = F.schema_of_variant(F.try_variant_get("v", path, "variant"))
        got = F.regexp_extract(tag, r"^([A-Z]+)", 1)
        ok = got.isin("BIGINT", "DECIMAL", "DOUBLE") if want == "number" else got == want
        rules.append(Rule("wrong_type", "error", F.col("v").isNotNull() & ~F.coalesce(ok, F.lit(False)), F.concat(F.lit(f"{path} "), F.coalesce(got, F.lit("missing")))))
    return apply_rules(v, key, rules)


# ---- JSON schemas compiled to columns ----------------------------------------------------
_TAGS = {"string": ("STRING",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}
_NO_ERRORS = "array<string>"


def _none() -> Column:
    return F.array().cast(_NO_ERRORS)


def _error(when: Column, path: Column, what: str | Column) -> Column:
    what = F.lit(what) if isinstance(what, str) else what
    return F.when(when, F.array(F.concat(path, F.lit(": "), what))).otherwise(_none())


def _join(path: Column, name: str | Column) -> Column:
    return F.concat(path, F.lit("."), F.lit(name) if isinstance(name, str) else name)


def schema_errors(value: Column, schema: dict, path: Column, variant: bool = False) -> Column:
    """``array<string>`` of ``path: error`` for a typed column or a VARIANT.

    Of a typed column a null stands for what is missing, and its type needs no check.
    """
    kind = schema.get("type") or ("string" if "enum" in schema else None)
    get = (lambda t: F.try_variant_get(value, "$", t)) if variant else (lambda t: value)
    tag = F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1) if variant else None
    right = tag.isin(*_TAGS[kind]) if variant else value.isNotNull()
    parts: list[Column] = []
    if kind == "string":
        x = get("string")
        if "minLength" in schema:
            parts.append(_error(F.length(x) < schema["minLength"], path, f"shorter than {schema['minLength']}"))
        if "enum" in schema:
            parts.append(_error(~x.isin(*schema["enum"]), path, F.concat(F.lit("unknown value "), x)))
    elif kind == "number":
        x = get("double")
        if "minimum" in schema:
            parts.append(_error(x < schema["minimum"], path, f"less than {schema['minimum']}"))
        if "exclusiveMinimum" in schema:
            parts.append(_error(x <= schema["exclusiveMinimum"], path, f"not greater than {schema['exclusiveMinimum']}"))
    elif kind == "array":
        x = get("array<variant>")
        if "minItems" in schema:
            parts.append(_error(F.size(x) < schema["minItems"], path, f"fewer than {schema['minItems']} items"))
        if schema.get("uniqueItems"):
            same = F.transform(x, lambda e: F.to_json(e)) if variant else x
            parts.append(_error(F.size(F.array_distinct(same)) < F.size(x), path, "repeated items"))
        parts.append(F.flatten(F.transform(x, lambda e, i: schema_errors(e, schema["items"], _join(path, i.cast("string")), variant))))
    elif kind == "object":
        extra, named = schema.get("additionalProperties", True), schema.get("properties", {})
        members = get("map<string,variant>")
        for name, sub in named.items():
            child = F.try_variant_get(value, f"$.{name}", "variant") if variant else value[name]
            errors = schema_errors(child, sub, _join(path, name), variant)
            if not variant:
                parts.append(errors)  # a null is reported as missing by the child itself
            elif name in schema.get("required", ()):
                parts.append(F.when(child.isNull(), F.array(F.concat(_join(path, name), F.lit(": missing")))).otherwise(errors))
            else:
                parts.append(F.when(child.isNull(), _none()).otherwise(errors))
        if "minProperties" in schema:
            parts.append(_error(F.size(members) < schema["minProperties"], path, f"fewer than {schema['minProperties']} members"))
        if isinstance(extra, dict):
            parts.append(F.flatten(F.transform(F.map_entries(members), lambda e: schema_errors(e["value"], extra, _join(path, e["key"]), variant))))
        elif extra is False and variant:
            unknown = F.array_except(F.map_keys(members), F.array(*[F.lit(k) for k in named]))
            parts.append(F.transform(F.array_sort(unknown), lambda k: F.concat(_join(path, k), F.lit(": unknown member"))))
    inner = F.concat(*[F.coalesce(p, _none()) for p in parts]) if parts else _none()
    wrong = F.when(value.isNull(), F.lit("missing")).otherwise(F.concat(F.lit("is "), F.lower(tag))) if variant else F.lit("missing")
    return F.when(F.coalesce(right, F.lit(False)), inner).otherwise(F.array(F.concat(path, F.lit(": "), wrong)))


def rubric_schema_rules() -> list[Rule]:
    """Every error of a typed record's rubric against its JSON schema."""
    return [Rule("schema", "error", F.lit(True), many=schema_errors(F.col("rubric"), RUBRIC_SCHEMA, F.lit("rubric")))]


def prediction_schema_rules() -> list[Rule]:
    """Every error of a typed prediction against its JSON schema."""
    row = F.struct(*[F.col(c) for c in PREDICTION_SCHEMA["properties"]])
    return [Rule("schema", "error", F.lit(True), many=schema_errors(row, PREDICTION_SCHEMA, F.lit("prediction")))]


def raw_schema_findings(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Every error of the rubric in JSON text; unreadable text is left to ``type_findings``."""
    v = df.select(key, F.try_parse_json(F.col(payload)).alias("v")).where(F.col("v").isNotNull())
    v = v.select(key, F.try_variant_get("v", "$.rubric", "variant").alias("rubric"))
    return apply_rules(v, key, [Rule("schema", "error", F.lit(True), many=schema_errors(F.col("rubric"), RUBRIC_SCHEMA, F.lit("rubric"), True))])
