"""The given tables, read as this domain's inputs.

Every mapping is row-local or a join: an order line with its order, part and
supplier is one report document whose arrays are built from that row, and a text
document is one assessed case whose reactions are its lines. (Order key, line
number) repeats in the data, which gives reports with several versions.

Join sides are broadcast only where Spark's own size check allows it; a hot key on
a shuffled side is split by adaptive execution.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewise.operators.assessors import with_reply
from casewise.operators.silver import latest_made
from casewise.schema import BRONZE_SCHEMA
from casewise.sources import fresh_path, write_ndjson

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("event_ts", T.StringType()),
    ]
)


# Declared, so that no query reads file footers just to learn the columns it needs.
_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables with the columns this workload uses."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Deal the rows out evenly, whatever files they come in; the plan is the same at any size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _by_value(column: Column, values: dict) -> Column:
    chain = F
    for key, value in values.items():
        chain = chain.when(column == key, value)
    return chain


# --- report documents --------------------------------------------------------------


def _compact(day: str) -> str:
    """``yyyyMMdd`` of a date, by arithmetic where the year has four digits: a tenth of the time."""
    digits = f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) AS STRING)"
    return f"CASE WHEN year({day}) BETWEEN 1000 AND 9999 THEN {digits} ELSE date_format({day}, 'yyyyMMdd') END"


# Texts that several fields use; columns of their own, so they are computed once.
_TEXTS = {
    "shipped": _compact("cast(l_shipdate AS DATE)"),
    "received": _compact("cast(least(o_orderdate, l_shipdate) AS DATE)"),
    "number": "cast(l_linenumber AS STRING)",
    "quantity": "cast(cast(l_quantity AS INT) AS STRING)",
}

_DRUGS = (
    {
        "activesubstance": {"activesubstancename": "concat('  ', lower(p_brand), chr(9))"},
        "drugcharacterization": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END",
        "drugindication": "p_type",
        "drugstartdate": "shipped",
        "drugstartdateformat": "'102'",
        "medicinalproduct": "concat(' ', p_name)",
        "openfda": {"generic_name": "array(p_type, p_brand)", "manufacturer_name": "array(s_name)"},
    },
    {
        "activesubstance": {"activesubstancename": "lower(p_type)"},
        "drugcharacterization": "'2'",
        "drugstartdate": "left(shipped, 6)",
        "drugstartdateformat": "'610'",
        "drugenddate": "left(shipped, 4)",
        "drugenddateformat": "'602'",
        "openfda": {"generic_name": "cast(array() AS ARRAY<STRING>)"},
    },
    {"drugcharacterization": "'9'", "drugenddate": "shipped", "medicinalproduct": "p_name"},
    {
        "activesubstance": {"activesubstancename": "upper(p_brand)"},
        "drugcharacterization": "'1'",
        "medicinalproduct": "upper(p_name)",
    },
)
_REACTIONS = (
    {
        "reactionmeddrapt": "concat(lower(n_name), ' ')",
        "reactionmeddraversionpt": "'26.1'",
        "reactionoutcome": "number",
    },
    {
        "reactionmeddrapt": "concat(p_name, ' ', cast(p_size AS STRING))",
        "reactionmeddraversionpt": "'26.0'",
    },
    {"reactionmeddraversionpt": "'26.0'", "reactionoutcome": "'5'"},
)

# A line without tax shows its first element only.
_SHOWN = "CASE WHEN l_tax = 0 THEN 1 ELSE 4 END"

_DOCUMENT = {
    "safetyreportid": "concat_ws('-', cast(l_orderkey AS STRING), number)",
    "safetyreportversion": "CASE WHEN l_tax = 0.08D THEN concat('v', quantity) ELSE quantity END",
    "receivedate": "received",
    "receivedateformat": "'102'",
    "receiptdate": """CASE o_orderpriority
        WHEN '1-URGENT' THEN
            CASE WHEN l_discount = 0.1D THEN concat(left(shipped, 4), '0231') ELSE shipped END
        WHEN '2-HIGH' THEN left(shipped, 6)
        WHEN '3-MEDIUM' THEN left(shipped, 4)
        WHEN '5-LOW' THEN left(shipped, 6)
        ELSE shipped END""",
    "receiptdateformat": """CASE o_orderpriority
        WHEN '1-URGENT' THEN '102' WHEN '2-HIGH' THEN '610' WHEN '3-MEDIUM' THEN '602' END""",
    "serious": "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' WHEN 'P' THEN '3' END",
    "seriousnessdeath": "CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' END",
    "seriousnesshospitalization": "CASE l_linestatus WHEN 'F' THEN '1' END",
    "seriousnesslifethreatening": "CASE number WHEN '7' THEN '1' ELSE '2' END",
    "occurcountry": "n_name",
    "companynumb": """concat_ws('-', cast(l_partkey AS STRING), cast(l_suppkey AS STRING),
        cast(cast(round(l_extendedprice * 100) AS BIGINT) AS STRING),
        cast(cast(round(l_discount * 100) AS BIGINT) AS STRING),
        cast(cast(round(l_tax * 100) AS BIGINT) AS STRING), l_returnflag, l_linestatus)""",
    "duplicate": "CASE WHEN l_tax = 0.04D THEN '1' END",
    "primarysource": """CASE WHEN l_discount <> 0.01D THEN
        named_struct('qualification', number, 'reportercountry', n_name) END""",
    "patient": {
        "patientonsetage": "CASE WHEN l_tax = 0.07D THEN 'adult' ELSE quantity END",
        "patientonsetageunit": "'801'",
        "patientsex": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '0' END",
        "drug": "CASE WHEN l_discount <> 0 THEN slice(drugs, 1, {shown}) END",
        "reaction": "slice(reactions, 1, CASE WHEN l_discount = 0.1D THEN 0 ELSE {shown} END)",
    },
}


def _sql(value: dict | str | None, dtype: T.DataType) -> str:
    """SQL text of a value of ``dtype``: a dict is a struct whose absent fields are null."""
    if value is None:
        return f"cast(NULL AS {dtype.simpleString()})"
    if isinstance(value, str):
        return value
    fields = (f"'{f.name}', {_sql(value.get(f.name), f.dataType)}" for f in dtype)
    return f"named_struct({', '.join(fields)})"


def _order_lines(spark: SparkSession, sf_dir: str, orders_last: bool = False) -> DataFrame:
    """Every order line with its order, part and supplier: what one document is made of.

    The join with the orders is a shuffle at any size, which also deals the lines out evenly
    whatever files they come in. As the last join it leaves them lying by order.
    """
    line, order, part, supplier, nation = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "part", "supplier", "nation")
    )
    joins = [
        (order.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")),
        (part, F.col("l_partkey") == F.col("p_partkey")),
        (supplier, F.col("l_suppkey") == F.col("s_suppkey")),
        (nation, F.col("s_nationkey") == F.col("n_nationkey")),
    ]
    for side, on in [*joins[1:], joins[0]] if orders_last else joins:
        line = line.join(side, on)
    return line.drop("o_orderkey", "p_partkey", "s_suppkey", "s_nationkey", "n_nationkey")


def _made(lines: DataFrame, *carried: str, schema: T.StructType = BRONZE_SCHEMA) -> DataFrame:
    """The document of each line, or its fields in ``schema``, with the ``carried`` columns behind it."""
    patient = schema["patient"].dataType
    first, second, third, fourth = (_sql(d, patient["drug"].dataType.elementType) for d in _DRUGS)
    place, rare, fatal = (_sql(r, patient["reaction"].dataType.elementType) for r in _REACTIONS)
    texts = lines.selectExpr("*", *(f"{text} AS {name}" for name, text in _TEXTS.items()))
    arrays = texts.selectExpr(
        "*",
        f"array({first}, {second}, CASE l_linestatus WHEN 'O' THEN {third} END, {fourth}) AS drugs",
        f"array({place}, {rare}, CASE WHEN l_returnflag <> 'N' THEN {fatal} END) AS reactions",
    )
    return arrays.selectExpr(
        *(
            f"{_sql(_DOCUMENT[field.name], field.dataType)} AS {field.name}".replace("{shown}", _SHOWN)
            for field in schema
        ),
        *carried,
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze document per order line."""
    return _made(_order_lines(spark, sf_dir))


_FILES: dict[tuple[str, str, bool], str] = {}


def document_files(spark: SparkSession, sf_dir: str, quick: bool = False) -> str:
    """The documents as gzipped files in the work folder, written once per application.

    ``quick`` is for a query that writes little else, as its files are larger.
    """
    key = spark.sparkContext.applicationId, sf_dir, quick
    if key not in _FILES:
        path = fresh_path(spark, "documents")
        write_ndjson(documents(spark, sf_dir), path, compression="gzip", quick=quick)
        _FILES[key] = path
    return _FILES[key]


def latest(
    spark: SparkSession, sf_dir: str, schema: T.StructType = BRONZE_SCHEMA
) -> DataFrame:
    """The newest version of each document, cut by all of it, with the fields of ``schema``.

    A report id begins with its order's key, so the cut is made where the join with the orders left the lines.
    """
    lines = _order_lines(spark, sf_dir, orders_last=True)
    return latest_made(lines, _made, partial(_made, schema=schema), within="l_orderkey")


# --- text documents as cases --------------------------------------------------------


def _lines() -> Column:
    return F.split("text", "\n")


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _label() -> Column:
    return F.when(F.col("quality") == 1, "serious").when(F.col("quality") == 0, "non_serious")


def text_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case per text document: its source is the drug, its lines are the reactions."""
    none = F.lit(None).cast("string")
    return _labelled_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("safetyreportid"),
        none.alias("patient_sex"),
        F.col("n_chars").cast("double").alias("patient_onset_age"),
        F.col("lang").alias("occur_country"),
        F.array(
            F.struct(
                F.col("source").alias("active_substance"),
                none.alias("medicinal_product"),
                F.lit("suspect").alias("drug_role"),
                none.alias("indication"),
            )
        ).alias("drugs"),
        F.transform(
            _lines(), lambda line: F.struct(line.alias("reaction_term"), none.alias("reaction_outcome"))
        ).alias("reactions"),
        _label().alias("label_seriousness"),
    )


def uneven_assessor(cases: DataFrame, attempt: int) -> DataFrame:
    """Replies of mixed quality, so that every branch of the flow is taken.

    The first reply repeats the whole text, which breaks the length and count rules
    for most cases. The second is short. One source cannot be called at all, and one
    language never gets a seriousness.
    """
    language, source = F.col("occur_country"), F.col("drugs")[0]["active_substance"]
    terms = F.transform("reactions", lambda r: r["reaction_term"])
    label = F.col("label_seriousness")
    first = attempt == 1
    german = "Serious" if first else "serious"
    reply = F.to_json(
        F.struct(
            _by_value(language, {"en": "serious", "fr": "non_serious", "de": german}).alias("seriousness"),
            F.when(label == "non_serious", "   ")
            .otherwise(F.concat(F.lit(" "), source, F.lit(" ")))
            .alias("primary_suspect"),
            (terms if first else F.array(source, language)).alias("key_reactions"),
            F.when(label == "serious", "high")
            .when(label == "non_serious", "low")
            .otherwise("medium")
            .alias("confidence"),
            (F.array_join(terms, "\n") if first else F.concat_ws(": ", source, language)).alias("rationale"),
            # A second reply is long, so that a dead letter that keeps less than all shows it.
            F.when(F.lit(not first), F.rpad(source, 1500, ".")).alias("notes"),
        )
    )
    reachable = source != "src3"
    return with_reply(
        cases,
        F.when(reachable, reply),
        F.when(reachable, F.col("patient_onset_age")).otherwise(0),
        F.when(reachable, F.array_size("reactions") if first else F.lit(2)).otherwise(0),
        F.lit(0),
        F.when(~reachable, F.concat(F.lit("Throttled: "), source)),
    )


def text_cache(spark: SparkSession, sf_dir: str, keyed: DataFrame) -> DataFrame:
    """A cache table with an entry for every labelled case.

    Entries of the non-serious ones are unreadable, so those cases must miss.
    """
    label = F.col("label_seriousness")
    reply = F.to_json(
        F.struct(
            label.alias("seriousness"),
            F.lit("low").alias("confidence"),
            F.lit("from an earlier run").alias("rationale"),
        )
    )
    raw = F.when(label == "serious", reply).otherwise("{broken")
    cached = with_reply(keyed.filter(label.isNotNull()), raw, F.lit(7), F.lit(3), F.lit(11))
    return cached.select("content_key", "raw_reply", "input_tokens", "output_tokens", "latency_ms")


def text_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One enriched row per text document, with labels, abstentions and misses."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    language = F.col("lang")
    suspect = F.when(toxic, "UNLISTED").when(language != "es", F.upper("source"))
    return _labelled_documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("safetyreportid"),
        F.struct(
            F.when(toxic, "non_serious").otherwise("serious").alias("seriousness"),
            suspect.alias("primary_suspect"),
            F.array().cast("array<string>").alias("key_reactions"),
            _by_value(language, {"en": "high", "fr": "medium", "de": "low"}).alias("confidence"),
            F.col("source").alias("rationale"),
        ).alias("assessment"),
        F.lit("model-a").alias("model_id"),
        F.lit("v1").alias("prompt_version"),
        F.col("n_chars").alias("input_tokens"),
        F.size(_lines()).cast("bigint").alias("output_tokens"),
        F.col("n_chars").cast("int").alias("latency_ms"),
        (language == "de").alias("cached"),
        _label().alias("label_seriousness"),
        F.lit(None).cast("string").alias("label_primary_suspect"),
        F.array("source", "lang").alias("input_substances"),
    )


# --- events as messages ------------------------------------------------------------


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("string").alias("event_ts")
    )


def torn_line() -> Column:
    """An event's message, broken off half-way."""
    return F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "er'))


def event_lines(spark: SparkSession, sf_dir: str, which: str = "true") -> DataFrame:
    """One message text per event; those of type ``error`` break off half-way."""
    line = F.when(F.col("event_type") == "error", torn_line()).otherwise(F.to_json(F.struct("*")))
    return event_documents(spark, sf_dir).where(which).select(line.alias("value"))

