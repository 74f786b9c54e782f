"""Builders of small inputs."""

from __future__ import annotations

import json
from pathlib import Path


def drug(substance="DUPILUMAB", role="1", **other) -> dict:
    return {
        "activesubstance": None if substance is None else {"activesubstancename": substance},
        "drugcharacterization": role,
        "drugstartdate": "20230915",
        "drugstartdateformat": "102",
        "medicinalproduct": "Brand " + (substance or "x"),
        "openfda": {"generic_name": ["generic"], "manufacturer_name": ["maker", "other"]},
        **other,
    }


def reaction(term="Nausea", outcome="1", **other) -> dict:
    return {
        "reactionmeddrapt": term,
        "reactionmeddraversionpt": "26.1",
        "reactionoutcome": outcome,
        **other,
    }


def report(key="R1", drugs=None, reactions=None, **other) -> dict:
    patient = {
        "patientonsetage": other.pop("age", "45"),
        "patientonsetageunit": "801",
        "patientsex": other.pop("sex", "2"),
        "drug": [drug()] if drugs is None else drugs,
        "reaction": [reaction()] if reactions is None else reactions,
    }
    return {
        "safetyreportid": key,
        "safetyreportversion": "1",
        "receivedate": "20240105",
        "receivedateformat": "102",
        "receiptdate": "20240110",
        "receiptdateformat": "102",
        "serious": "1",
        "seriousnesshospitalization": "1",
        "occurcountry": "US",
        "primarysource": {"qualification": "1", "reportercountry": "US"},
        "patient": patient,
        **other,
    }


def enriched(key="R1", actual="serious", predicted="serious", **other) -> dict:
    assessment = {
        "seriousness": predicted,
        "primary_suspect": other.pop("suspect", None),
        "key_reactions": [],
        "confidence": other.pop("confidence", "high"),
        "rationale": "because",
    }
    return {
        "safetyreportid": key,
        "assessment": assessment,
        "model_id": "m",
        "prompt_version": "v1",
        "input_tokens": 100,
        "output_tokens": 10,
        "latency_ms": other.pop("latency", 1000),
        "cached": other.pop("cached", False),
        "label_seriousness": actual,
        "label_primary_suspect": None,
        "input_substances": other.pop("substances", []),
        **other,
    }


def case(key="R1", **other) -> dict:
    return {
        "safetyreportid": key,
        "patient_sex": "female",
        "patient_onset_age": 45.0,
        "occur_country": "US",
        "drugs": [
            {"active_substance": "DUPILUMAB", "medicinal_product": "B", "drug_role": "suspect", "indication": None}
        ],
        "reactions": [{"reaction_term": "NAUSEA", "reaction_outcome": "recovered"}],
        "label_seriousness": "serious",
        **other,
    }


def write_lines(path: Path, rows: list) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = (row if isinstance(row, str) else json.dumps(row) for row in rows)
    path.write_text("\n".join(lines) + "\n")
    return str(path)
