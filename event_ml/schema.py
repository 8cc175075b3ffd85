"""Declared schemas of the labelled event table and its derived forms."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# --- fixed values: column names and order of the labelled event table -------
# (these names must stay exactly as listed; they are the input file layout)
LABEL = "label"
EVENT_FEATURES = [
    "lepton_pT", "lepton_eta", "lepton_phi",
    "missing_energy_magnitude", "missing_energy_phi",
    "jet1_pT", "jet1_eta", "jet1_phi", "jet1_b_tag",
    "jet2_pT", "jet2_eta", "jet2_phi", "jet2_b_tag",
    "jet3_pT", "jet3_eta", "jet3_phi", "jet3_b_tag",
    "jet4_pT", "jet4_eta", "jet4_phi", "jet4_b_tag",
    "m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
]
ENGINEERED_FEATURES = [
    "lepton_to_jet_pT_ratio",
    "total_visible_pT",
    "bjet_multiplicity",
    "mass_ratio_bb_wwbb",
    "delta_eta_leading_jets",
]
# --- end of fixed values -----------------------------------------------------

LOW_LEVEL = EVENT_FEATURES[:21]
HIGH_LEVEL = EVENT_FEATURES[21:]
ALL_FEATURES = EVENT_FEATURES + ENGINEERED_FEATURES
ANON_FEATURES = [f"feature_{i}" for i in range(1, len(EVENT_FEATURES) + 1)]
CORRUPT_COLUMN = "_corrupt_record"


def event_schema(float_type: T.DataType | None = None) -> T.StructType:
    """Label + 28 features, all nullable floats (the declared ingest schema)."""
    ft = float_type or T.FloatType()
    return T.StructType([T.StructField(n, ft, True) for n in [LABEL, *EVENT_FEATURES]])


def anonymous_schema(float_type: T.DataType | None = None) -> T.StructType:
    ft = float_type or T.DoubleType()
    return T.StructType([T.StructField(n, ft, True) for n in [LABEL, *ANON_FEATURES]])


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


def feature_group(name: str) -> str:
    if name in LOW_LEVEL:
        return "low_level"
    if name in HIGH_LEVEL:
        return "high_level"
    if name in ENGINEERED_FEATURES:
        return "engineered"
    return "other"


def schema_to_json_map(schema: T.StructType) -> str:
    """``{column: type}`` JSON, the file format of the schema sink."""
    return json.dumps({f.name: str(f.dataType) for f in schema.fields}, indent=2)


def schema_from_json(text: str) -> T.StructType:
    """Inverse of ``StructType.json()`` (full-fidelity schema round trip)."""
    return T.StructType.fromJson(json.loads(text))


def check_schema_map(mapping: dict[str, str], expected_columns: int = 29) -> list[str]:
    """Problems found in a ``{column: type}`` map (empty list means OK)."""
    problems = []
    if LABEL not in mapping:
        problems.append("missing label column")
    if len(mapping) != expected_columns:
        problems.append(f"expected {expected_columns} columns, found {len(mapping)}")
    return problems
