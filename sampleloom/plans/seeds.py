"""Small vocabularies for the registered queries and the tests; users supply their own through the same tables.

Each seed is one list of rows, given to Spark as a DataFrame and to the checking SQL as VALUES.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sampleloom.operators.ranking import local_frame

#: taxid, rank, scientific_name, synonym, genbank_common_name, common_name; row order is specificity.
TAXA_COLUMNS = "taxid long, rank string, scientific_name string, synonym string, genbank_common_name string, common_name string, table_priority long"
TAXA = [
    (91001, "species", "Ursina fulva", "Ursa fulva", "brindle ox", "ox;field ox", 0),
    (91002, "species", "Ovilla dentata", "Ovis dentata", "grey hen", "hen", 1),
    (91003, "species", "Velumia agrestis", None, "marsh goat", "goat;bog goat", 2),
    (91004, "species", "Bramidus oxenii", "Bramida oxenii", "reed duck", "duck", 3),
    (91005, "species", "Pelagoma vasta", None, "stone carp", "carp", 4),
    (91006, "species", "Corvessa lutea", None, "lowland mule", "mule", 5),
    (91007, "species", "Tarsula minor", None, "plain hare", "hare", 6),
    (91008, "subspecies", "Tarsula minor minor", None, None, None, 7),
    (91009, "genus", "Tarsula", None, None, "hares", 8),
]
#: taxid, parent, rank, name of the lineage tree; taxid 1 is its own parent.
NODES_COLUMNS = "taxid long, parent long, rank string, name string"
NODES = [
    (1, 1, "no rank", "root"),
    (90000, 1, "superkingdom", "Animata"),
    (90010, 90000, "class", "Pilosa"),
    (90011, 90010, "clade", "Innominata"),
    (90012, 90011, "family", "Ursinidae"),
    (90013, 90010, "family", "Avidae"),
    (90014, 90000, "class", "Natantia"),
    (91001, 90012, "species", "Ursina fulva"),
    (91002, 90013, "species", "Ovilla dentata"),
    (91003, 90012, "species", "Velumia agrestis"),
    (91004, 90013, "species", "Bramidus oxenii"),
    (91005, 90014, "species", "Pelagoma vasta"),
    (91006, 90012, "species", "Corvessa lutea"),
    (91009, 90012, "genus", "Tarsula"),
    (91007, 91009, "species", "Tarsula minor"),
    (91008, 91007, "subspecies", "Tarsula minor minor"),
]
#: normalised value, forced taxid or null for a rejection.
PREEMPT_COLUMNS = "norm_value string, taxid long"
PREEMPT = [("grey hen", 91004), ("not applicable", None), ("na", None)]
IGNORED_SUBSTRINGS = ["healthy", "adult", "strain ", "(juv.)"]
ISOLATION_KEYWORDS = ["meat", "raw curd", "silt"]
#: country, continent, UN region.
COUNTRY_COLUMNS = "alias string, country string, continent string, un_region string"
COUNTRIES = [
    ("quessant", "Quessant", "Aldera", "Western Aldera"), ("quessant isle", "Quessant", "Aldera", "Western Aldera"), ("norvelia", "Norvelia", "Aldera", "Northern Aldera"),
    ("tavira isles", "Tavira Isles", "Oceana", "Outer Oceana"), ("selmark", "Selmark", "Aldera", "Northern Aldera"), ("zuberland", "Zuberland", "Boreas", "Boreas"),
    ("ostrany", "Ostrany", "Aldera", "Eastern Aldera"), ("peskar", "Peskar", "Boreas", "Boreas"), ("ilvan republic", "Ilvan Republic", "Oceana", "Inner Oceana"),
    ("mardovia", "Mardovia", "Aldera", "Eastern Aldera"),
]
REMAP_COLUMNS = "country string, mapped string"
REMAP = [("Ilvan Republic", "Ilvania"), ("Tavira Isles", "Tavira")]
OFFICIAL_NAMES = ["Quessant", "Norvelia", "Tavira", "Selmark", "Ostrany", "Peskar", "Ilvania"]
#: place, country, latitude, longitude.
GAZETTEER_COLUMNS = "place string, country string, lat double, lon double"
GAZETTEER = [("Brae Harbour", "Quessant", 48.4, -5.1), ("Port Astrin", "Norvelia", 61.0, 7.5), ("Lake Veth", "Ostrany", 52.2, 24.8), ("Corr", "Ilvan Republic", -12.5, 130.0), ("Ohn", "Zuberland", 70.1, -150.3), ("Sel Plain", "Mardovia", 45.0, 45.0)]
#: key, ordinal, scientific name, rank, taxid.
REGISTRY_COLUMNS = "key string, ordinal int, scientific_name string, rank string, taxid long"
REGISTRY = [("q_varensis", 0, "Quorella varensis", "species", 70000), ("q_lutea", 1, "Quorella lutea", "species", 70013), ("b_oxalis", 2, "Quorella oxalis", "species", 70026), ("m_tarda", 3, "Quorella tarda", "species", 70039), ("p_fulva", 4, "Pelagoma", "genus", 70052)]


def frame(spark: SparkSession, rows: list, columns: str) -> DataFrame:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in columns.split(", "))])
    named = [dict(zip(schema.names, r if isinstance(r, tuple) else (r,))) for r in rows]
    return local_frame(spark, pa.Table.from_pylist(named, schema), columns)


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def values(rows: list, columns: str, name: str) -> str:
    """``name(columns) AS (VALUES ...)`` for a WITH clause; numbers and texts only."""
    cols = [c.split() for c in columns.split(", ")]
    kinds = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    body = ", ".join("(" + ", ".join(_literal(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    cast = ", ".join(f"CAST({c} AS {kinds[k]}) AS {c}" for c, k in cols)
    return f"{name} AS (SELECT {cast} FROM (VALUES {body}) AS t({', '.join(c for c, _ in cols)}))"
