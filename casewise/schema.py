"""Document schema, stored-table columns and code tables.

The bronze schema is declared, never inferred: every leaf is a string and typing
happens in silver, so a change in the source shows up as a change in this file.
"""

from __future__ import annotations

from pyspark.sql import types as T

def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _record(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


def _field(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype)


TEXT_LIST = T.ArrayType(T.StringType())

# Field names of the public case-report format.
DRUG_SCHEMA = _record(
    _field("activesubstance", _record(*_texts("activesubstancename"))),
    *_texts("drugcharacterization", "drugdosagetext", "drugindication"),
    *_texts("drugstartdate", "drugstartdateformat", "drugenddate", "drugenddateformat"),
    *_texts("medicinalproduct"),
    _field(
        "openfda",
        _record(
            _field("application_number", TEXT_LIST),
            _field("brand_name", TEXT_LIST),
            _field("generic_name", TEXT_LIST),
            _field("manufacturer_name", TEXT_LIST),
            _field("substance_name", TEXT_LIST),
        ),
    ),
)
REACTION_SCHEMA = _record(*_texts("reactionmeddrapt", "reactionmeddraversionpt", "reactionoutcome"))
PATIENT_SCHEMA = _record(
    *_texts("patientonsetage", "patientonsetageunit", "patientsex"),
    _field("drug", T.ArrayType(DRUG_SCHEMA)),
    _field("reaction", T.ArrayType(REACTION_SCHEMA)),
)
BRONZE_SCHEMA = _record(
    *_texts("safetyreportid", "safetyreportversion"),
    *_texts("receivedate", "receivedateformat", "receiptdate", "receiptdateformat"),
    *_texts("serious", "seriousnessdeath", "seriousnesshospitalization", "seriousnesslifethreatening"),
    *_texts("occurcountry", "companynumb", "duplicate"),
    _field("primarysource", _record(*_texts("qualification", "reportercountry"))),
    _field("patient", PATIENT_SCHEMA),
)


def _without(unused: set[str], dtype: T.DataType, path: str = "") -> T.DataType:
    """The type with the fields at the given dotted paths left out."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_without(unused, dtype.elementType, path))
    if isinstance(dtype, T.StructType):
        paths = {field.name: f"{path}.{field.name}".lstrip(".") for field in dtype}
        kept = (field for field in dtype if paths[field.name] not in unused)
        return _record(
            *(_field(f.name, _without(unused, f.dataType, paths[f.name])) for f in kept)
        )
    return dtype


# What no table, case or signal takes from a document. The transform's scan leaves it
# out, so it is neither parsed into rows nor shuffled.
_UNUSED = {
    "primarysource.qualification",
    "patient.drug.drugdosagetext",
    "patient.drug.openfda.application_number",
    "patient.drug.openfda.brand_name",
    "patient.drug.openfda.substance_name",
}
TRANSFORM_SCHEMA = _without(_UNUSED, BRONZE_SCHEMA)

# Date-format codes (full day, month, year).
DATE_FULL, DATE_MONTH, DATE_YEAR = "102", "610", "602"

# Code tables.
SEX_CODES = {"1": "male", "2": "female"}
SERIOUS_CODES = {"1": "serious", "2": "non_serious"}
DRUG_ROLE_CODES = {"1": "suspect", "2": "concomitant", "3": "interacting"}
REACTION_OUTCOME_CODES = {
    "1": "recovered",
    "2": "recovering",
    "3": "not_recovered",
    "4": "recovered_with_sequelae",
    "5": "fatal",
    "6": "unknown",
}

# The case handed to an assessor: one nested row per report, label alongside.
CASE_SCHEMA = _record(
    *_texts("safetyreportid", "patient_sex"),
    _field("patient_onset_age", T.DoubleType()),
    *_texts("occur_country"),
    _field(
        "drugs",
        T.ArrayType(_record(*_texts("active_substance", "medicinal_product", "drug_role", "indication"))),
    ),
    _field("reactions", T.ArrayType(_record(*_texts("reaction_term", "reaction_outcome")))),
    *_texts("label_seriousness"),
)

# The assessment contract.
SERIOUSNESS_VALUES = ("serious", "non_serious")
CONFIDENCE_VALUES = ("high", "medium", "low")
MAX_KEY_REACTIONS = 5
MAX_RATIONALE_CHARS = 400

ASSESSMENT_SCHEMA = _record(
    *_texts("seriousness", "primary_suspect"),
    _field("key_reactions", TEXT_LIST),
    *_texts("confidence", "rationale"),
)

ENRICHED_SCHEMA = _record(
    *_texts("safetyreportid"),
    _field("assessment", ASSESSMENT_SCHEMA),
    *_texts("model_id", "prompt_version"),
    _field("input_tokens", T.LongType()),
    _field("output_tokens", T.LongType()),
    _field("latency_ms", T.IntegerType()),
    _field("cached", T.BooleanType()),
    *_texts("label_seriousness", "label_primary_suspect"),
    _field("input_substances", TEXT_LIST),
)

# What scoring reads of an enriched row.
SCORING_SCHEMA = _without(
    {"assessment.key_reactions", "assessment.rationale", "label_primary_suspect"}, ENRICHED_SCHEMA
)
