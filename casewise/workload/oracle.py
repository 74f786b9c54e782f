"""SQL counterparts of the registered queries, written for DuckDB.

They are written from the meaning of each query, not from its Spark plan: the order
lines are turned straight into typed rows, without documents in between.
"""

from __future__ import annotations

# --- shared table expressions ------------------------------------------------------

_LINE = """
line AS (
  SELECT *,
    l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS id,
    l_quantity::INT::VARCHAR AS quantity,
    strftime(l_shipdate, '%Y%m%d') AS shipped,
    CASE o_orderpriority WHEN '1-URGENT' THEN '102' WHEN '2-HIGH' THEN '610'
                         WHEN '3-MEDIUM' THEN '602' END AS receipt_format,
    concat_ws('-', l_partkey::VARCHAR, l_suppkey::VARCHAR,
      round(l_extendedprice * 100)::BIGINT::VARCHAR, round(l_discount * 100)::BIGINT::VARCHAR,
      round(l_tax * 100)::BIGINT::VARCHAR, l_returnflag, l_linestatus) AS company
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
),
typed AS (
  SELECT *,
    CASE WHEN l_tax = 0.08 THEN 'v' || quantity ELSE quantity END AS version,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN CASE WHEN l_discount = 0.1 THEN left(shipped, 4) || '0231' ELSE shipped END
      WHEN '2-HIGH' THEN left(shipped, 6)
      WHEN '5-LOW' THEN left(shipped, 6)
      WHEN '3-MEDIUM' THEN left(shipped, 4)
      ELSE shipped END AS receipt_text,
    CASE o_orderpriority
      WHEN '1-URGENT' THEN CASE WHEN l_discount = 0.1 THEN NULL ELSE l_shipdate::DATE END
      WHEN '2-HIGH' THEN date_trunc('month', l_shipdate)::DATE
      WHEN '4-NOT SPECIFIED' THEN l_shipdate::DATE END AS receipt_date,
    least(o_orderdate, l_shipdate)::DATE AS receive_date,
    CASE o_orderstatus WHEN 'F' THEN 'serious' WHEN 'O' THEN 'non_serious' END AS seriousness,
    CASE l_returnflag WHEN 'A' THEN 'male' WHEN 'N' THEN 'female' END AS sex,
    CASE WHEN l_tax = 0.07 THEN NULL ELSE quantity::DOUBLE END AS age,
    CASE WHEN l_discount = 0 THEN 0 WHEN l_tax = 0 THEN 1 ELSE 4 END AS drug_count,
    CASE WHEN l_discount = 0.1 THEN 0 WHEN l_tax = 0 THEN 1 ELSE 3 END AS reaction_count,
    CASE l_returnflag WHEN 'A' THEN 'suspect' WHEN 'N' THEN 'concomitant' ELSE 'interacting' END AS role,
    CASE l_linenumber WHEN 1 THEN 'recovered' WHEN 2 THEN 'recovering' WHEN 3 THEN 'not_recovered'
      WHEN 4 THEN 'recovered_with_sequelae' WHEN 5 THEN 'fatal' WHEN 6 THEN 'unknown' END AS outcome
  FROM line
),
typed_precision AS (
  SELECT *, CASE WHEN receipt_date IS NULL THEN 'unknown'
                 WHEN o_orderpriority = '2-HIGH' THEN 'month' ELSE 'day' END AS receipt_precision
  FROM typed
)"""

_LATEST = (
    _LINE
    + """,
latest AS (
  SELECT * FROM typed_precision
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY receipt_date DESC NULLS LAST,
    TRY_CAST(version AS INT) DESC NULLS LAST, company DESC) = 1
)"""
)

_CHILDREN = (
    _LATEST
    + """,
drug AS (
  SELECT id, 0 AS drug_seq, upper(p_name) AS medicinal_product, upper(p_brand) AS active_substance,
    p_type AS generic_name, s_name AS manufacturer, role AS drug_role, p_type AS indication,
    l_shipdate::DATE AS drug_start_date, NULL::DATE AS drug_end_date
  FROM latest WHERE drug_count >= 1
  UNION ALL
  SELECT id, 1, NULL, upper(p_type), NULL, NULL, 'concomitant', NULL,
    date_trunc('month', l_shipdate)::DATE, NULL
  FROM latest WHERE drug_count = 4
  UNION ALL
  SELECT id, 2, upper(p_name), NULL, NULL, NULL, NULL, NULL, NULL, l_shipdate::DATE
  FROM latest WHERE drug_count = 4 AND l_linestatus = 'O'
  UNION ALL
  SELECT id, 3, upper(p_name), upper(p_brand), NULL, NULL, 'suspect', NULL, NULL, NULL
  FROM latest WHERE drug_count = 4
),
reaction AS (
  SELECT id, 0 AS reaction_seq, upper(n_name) AS reaction_term, '26.1' AS meddra_version,
    outcome AS reaction_outcome
  FROM latest WHERE reaction_count >= 1
  UNION ALL
  SELECT id, 1, upper(p_name) || ' ' || p_size::VARCHAR, '26.0', NULL
  FROM latest WHERE reaction_count = 3
  UNION ALL
  SELECT id, 2, NULL, '26.0', 'fatal'
  FROM latest WHERE reaction_count = 3 AND l_returnflag <> 'N'
)"""
)

_PAIRS = (
    _CHILDREN
    + """,
every_pair AS (
  SELECT DISTINCT id, active_substance, reaction_term FROM drug JOIN reaction USING (id)
  WHERE active_substance IS NOT NULL AND reaction_term IS NOT NULL
),
pair AS (
  SELECT DISTINCT id, active_substance, reaction_term FROM drug JOIN reaction USING (id)
  WHERE drug_role = 'suspect' AND active_substance IS NOT NULL AND reaction_term IS NOT NULL
)"""
)

_SIGNALS = (
    _PAIRS
    + """,
counted AS (
  SELECT active_substance, reaction_term, count(*) AS a FROM pair GROUP BY ALL
),
cells AS (
  SELECT active_substance, reaction_term, a,
    d.n - a AS b, r.n - a AS c, (SELECT count(*) FROM pair) - d.n - r.n + a AS d
  FROM counted
    JOIN (SELECT active_substance, count(*) AS n FROM pair GROUP BY 1) d USING (active_substance)
    JOIN (SELECT reaction_term, count(*) AS n FROM pair GROUP BY 1) r USING (reaction_term)
),
shifted AS (
  SELECT *, (a = 0 OR b = 0 OR c = 0 OR d = 0) AS corrected,
    CASE WHEN a = 0 OR b = 0 OR c = 0 OR d = 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS s
  FROM cells
),
signal AS (
  SELECT active_substance, reaction_term, a AS report_count, a, b, c, d,
    round(((a + s) / (a + s + b + s)) / ((c + s) / (c + s + d + s)), 4) AS prr,
    corrected AS continuity_corrected, a >= 3 AS meets_min_count,
    CASE WHEN c = 0 THEN NULL
         ELSE round((a / (a + b)::DOUBLE) / (c / (c + d)::DOUBLE), 4) END AS uncorrected_prr
  FROM shifted
)"""
)

_CASES = (
    _CHILDREN
    + """,
cases AS (
  SELECT l.id, sex, age, n_name AS country, seriousness, d.drugs, r.reactions
  FROM latest l
    LEFT JOIN (SELECT id, list({'active_substance': active_substance,
        'medicinal_product': medicinal_product, 'drug_role': drug_role, 'indication': indication}
        ORDER BY drug_seq) AS drugs FROM drug GROUP BY id) d ON l.id = d.id
    LEFT JOIN (SELECT id, list({'reaction_term': reaction_term,
        'reaction_outcome': reaction_outcome} ORDER BY reaction_seq) AS reactions
        FROM reaction GROUP BY id) r ON l.id = r.id
),
rendered AS (
  SELECT *, concat_ws(chr(10), 'CASE', '',
    CASE WHEN age <> 0 OR sex IS NOT NULL THEN
      'Patient: ' || concat_ws(', ', CASE WHEN age <> 0 THEN 'age ' || printf('%g', age) END, sex) END,
    'Country: ' || country, '', 'What happened:',
    CASE WHEN reactions IS NULL THEN '  - nothing listed' ELSE
      array_to_string(list_transform(reactions, lambda x: '  - ' || coalesce(x.reaction_term, 'None') ||
        coalesce(' (outcome: ' || x.reaction_outcome || ')', '')), chr(10)) END,
    '', 'What was taken:',
    CASE WHEN drugs IS NULL THEN '  - nothing listed' ELSE
      array_to_string(list_transform(drugs, lambda x: '  - ' ||
        coalesce(x.active_substance, x.medicinal_product, 'product without a name') || ' (' ||
        coalesce(x.drug_role, 'role not stated') || ')' ||
        coalesce(', indication: ' || x.indication, '')), chr(10)) END,
    '', 'Reply with one JSON object that holds your assessment of this case.') AS text
  FROM cases
)"""
)

_FLAT_CASE = """
  SELECT id AS safetyreportid, sex AS patient_sex, age AS patient_onset_age,
    country AS occur_country, seriousness AS label_seriousness,
    array_to_string(list_transform(drugs, lambda x: coalesce(x.active_substance, '-') || '|' ||
      coalesce(x.medicinal_product, '-') || '|' || coalesce(x.drug_role, '-') || '|' ||
      coalesce(x.indication, '-')), ';') AS drugs,
    array_to_string(list_transform(reactions, lambda x: coalesce(x.reaction_term, '-') || '|' ||
      coalesce(x.reaction_outcome, '-')), ';') AS reactions
  FROM cases"""

_ENRICHED = """
enriched AS (
  SELECT doc_id::VARCHAR AS id, n_chars, lang, source,
    len(string_split(text, chr(10))) AS n_lines,
    CASE WHEN coalesce(toxic, 0) = 1 THEN 'non_serious' ELSE 'serious' END AS predicted,
    CASE quality WHEN 1 THEN 'serious' WHEN 0 THEN 'non_serious' END AS actual,
    CASE lang WHEN 'en' THEN 'high' WHEN 'fr' THEN 'medium' WHEN 'de' THEN 'low' END AS confidence,
    CASE WHEN coalesce(toxic, 0) = 1 THEN 'UNLISTED' WHEN lang <> 'es' THEN upper(source) END AS suspect,
    lang = 'de' AS cached
  FROM documents LEFT JOIN labels USING (doc_id)
),
scored AS (SELECT * FROM enriched WHERE actual IS NOT NULL),
matrix AS (
  SELECT count(*) AS n,
    count(*) FILTER (actual = 'serious' AND predicted = 'serious') AS tp,
    count(*) FILTER (actual <> 'serious' AND predicted = 'serious') AS fp,
    count(*) FILTER (actual <> 'serious' AND predicted <> 'serious') AS tn,
    count(*) FILTER (actual = 'serious' AND predicted <> 'serious') AS fn
  FROM scored
),
rate AS (
  SELECT *, (tp + tn) / n AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
    tn / (tn + fp) AS specificity, 2 * tp / (2 * tp + fp + fn) AS f1
  FROM matrix
),
majority AS (
  SELECT actual AS majority_class, count(*) / (SELECT count(*) FROM scored) AS majority_accuracy
  FROM scored GROUP BY actual ORDER BY count(*) DESC, actual LIMIT 1
),
kappa AS (
  SELECT (po - pe) / (1 - pe) AS cohens_kappa FROM (
    SELECT (SELECT avg((actual = predicted)::INT) FROM scored) AS po,
      (SELECT sum(a.n * p.n) / (SELECT count(*) FROM scored) ** 2
       FROM (SELECT actual AS label, count(*) AS n FROM scored GROUP BY 1) a
         JOIN (SELECT predicted AS label, count(*) AS n FROM scored GROUP BY 1) p USING (label)) AS pe)
),
grounded AS (
  SELECT count(suspect) AS checked,
    count(*) FILTER (suspect IS NOT NULL AND suspect NOT IN (upper(source), upper(lang))) AS invented,
    count(*) - count(suspect) AS abstained
  FROM enriched
),
ranked AS (
  SELECT n_chars, row_number() OVER (ORDER BY n_chars) AS r, count(*) OVER () AS n
  FROM enriched WHERE NOT cached
)"""


def _percentile(p: int) -> str:
    rank = f"greatest(1, least(n, round_even({p}::DOUBLE / 100 * n + 0.5, 0)))"
    return f"(SELECT n_chars::DOUBLE FROM ranked WHERE r = {rank})"


_REPLIES = """
text_case AS (
  SELECT doc_id::VARCHAR AS id, text, lang, source, n_chars,
    string_split(text, chr(10)) AS lines,
    CASE quality WHEN 1 THEN 'serious' WHEN 0 THEN 'non_serious' END AS label
  FROM documents LEFT JOIN labels USING (doc_id)
),
reply AS (
  SELECT *,
    CASE lang WHEN 'en' THEN 'serious' WHEN 'fr' THEN 'non_serious' END AS first_seriousness,
    CASE lang WHEN 'en' THEN 'serious' WHEN 'fr' THEN 'non_serious' WHEN 'de' THEN 'serious' END
      AS second_seriousness,
    CASE WHEN label = 'non_serious' THEN NULL ELSE upper(source) END AS suspect,
    CASE label WHEN 'serious' THEN 'high' WHEN 'non_serious' THEN 'low' ELSE 'medium' END AS confidence,
    source = 'src3' AS failed
  FROM text_case
),
first_reply AS (
  SELECT *, array_to_string(list_filter([
      CASE WHEN failed OR first_seriousness IS NULL THEN 'seriousness' END,
      CASE WHEN NOT failed AND len(lines) > 5 THEN 'key_reactions' END,
      CASE WHEN failed THEN 'confidence' END,
      CASE WHEN failed OR length(text) > 400 THEN 'rationale' END], lambda x: x IS NOT NULL), ';') AS errors
  FROM reply
),
outcome AS (
  SELECT *,
    CASE WHEN failed THEN 1 WHEN errors = '' THEN 1 ELSE 2 END AS attempts,
    CASE WHEN failed THEN 'dead' WHEN errors = '' THEN 'enriched'
         WHEN second_seriousness IS NULL THEN 'dead' ELSE 'enriched' END AS status,
    CASE WHEN failed THEN 'Throttled: src3'
         WHEN errors <> '' AND second_seriousness IS NULL THEN 'invalid_reply: seriousness' END AS reason,
    CASE WHEN failed THEN 0 WHEN errors = '' THEN n_chars ELSE 2 * n_chars END AS billed_input,
    CASE WHEN failed THEN 0 WHEN errors = '' THEN len(lines) ELSE len(lines) + 2 END AS billed_output
  FROM first_reply
)"""

_EVENT_DAYS = """
bounds AS (SELECT min(ts)::DATE AS first_day, max(ts)::DATE AS last_day FROM events),
window_plan AS (
  SELECT unnest(generate_series(first_day::TIMESTAMP, last_day::TIMESTAMP, INTERVAL 7 DAY))::DATE
    AS window_start FROM bounds
),
planned AS (
  SELECT window_start, least(window_start + 6, (SELECT last_day FROM bounds)) AS window_end
  FROM window_plan
)"""

_MANIFEST_RECORD = (
    "to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, "
    "'day': ts::DATE::VARCHAR})::VARCHAR"
)

_TORN = """'{"event_id": ' || event_id::VARCHAR || ', "event_type": "er'"""


def _with(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"


def _checks(*rows: tuple[str, str, str, str]) -> str:
    """One SELECT per check: name, table, bad-row condition, pass condition."""
    parts = (
        f"SELECT '{name}' AS \"check\", {passed} AS passed, total, bad "
        f"FROM (SELECT count(*) AS total, count(*) FILTER ({bad}) AS bad FROM {table})"
        for name, table, bad, passed in rows
    )
    return "\nUNION ALL\n".join(parts)


ORACLE: dict[str, str] = {
    # --- scans
    "bronze_scan": _with(
        _LINE,
        """SELECT id AS safetyreportid, version AS safetyreportversion, company AS companynumb,
             CASE WHEN l_discount <> 0.01 THEN l_linenumber::VARCHAR END AS qualification,
             CASE WHEN l_tax = 0.07 THEN 'adult' ELSE quantity END AS age_text, drug_count,
             CASE WHEN drug_count > 0 THEN '  ' || lower(p_brand) || chr(9) END AS first_substance,
             CASE WHEN reaction_count > 0 THEN lower(n_name) || ' ' END AS first_term
           FROM typed_precision""",
    ),
    "ndjson_scan": f"""
        SELECT event_id, user_id, event_type, value, NULL::VARCHAR AS raw_line FROM events
        UNION ALL SELECT NULL, NULL, NULL, NULL, {_TORN} FROM events WHERE event_type = 'error'""",
    "eval_scan": _with(
        _ENRICHED,
        """SELECT id AS safetyreportid, predicted AS seriousness, suspect AS primary_suspect,
             confidence, n_chars::INT AS latency_ms, cached, actual AS label_seriousness,
             source || ';' || lang AS substances
           FROM enriched""",
    ),
    "corrupt_split": f"""
        SELECT 'document' AS kind, event_id, NULL::VARCHAR AS raw_line
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT 'broken', NULL, {_TORN} FROM events WHERE event_type = 'error'""",
    "bronze_union": _with(
        _LINE,
        """SELECT CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS serious,
             count(*) + count(*) FILTER (l_returnflag = 'R') AS documents,
             count(*) FILTER (l_tax = 0.04) AS with_duplicate_flag
           FROM line GROUP BY 1""",
    ),
    # --- scalars
    "decode_codes": _with(
        _LINE,
        """SELECT id AS safetyreportid, company AS companynumb, seriousness, sex,
             CASE WHEN drug_count > 0 THEN role END AS first_role,
             CASE WHEN reaction_count > 0 THEN outcome END AS first_outcome
           FROM typed""",
    ),
    "partial_dates": _with(
        _LINE,
        """SELECT id AS safetyreportid, company AS companynumb, receipt_date,
             receipt_precision AS precision, strftime(receipt_date, '%Y%m%d') AS compact
           FROM typed_precision""",
    ),
    "normalize_terms": """
        SELECT p_partkey, upper(p_name) AS term,
          CASE WHEN p_size > 25 THEN NULL ELSE upper(p_type) END AS blank_term
        FROM part""",
    "content_key": _with(
        _CASES,
        """SELECT id AS safetyreportid, left(sha256('model-a|v1|' || to_json({
             'safetyreportid': id, 'patient_sex': sex, 'patient_onset_age': age,
             'occur_country': country, 'drugs': drugs, 'reactions': reactions})::VARCHAR), 32)
             AS content_key
           FROM cases""",
    ),
    "render_case": _with(_CASES, "SELECT id AS safetyreportid, text FROM rendered"),
    # --- silver
    "dedup_latest": _with(
        _LATEST,
        """SELECT id AS safetyreportid, version AS safetyreportversion,
             receipt_text AS receiptdate, company AS companynumb FROM latest""",
    ),
    "report_header": _with(
        _LATEST,
        """SELECT id AS safetyreportid, version AS safetyreportversion, receive_date, receipt_date,
             receipt_precision AS receipt_date_precision, seriousness,
             CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS outcome_death,
             CASE WHEN l_linestatus = 'F' THEN true END AS outcome_hospitalization,
             l_linenumber = 7 AS outcome_life_threatening,
             n_name AS occur_country,
             CASE WHEN l_discount <> 0.01 THEN n_name END AS reporter_country,
             company AS company_number,
             CASE WHEN l_tax = 0.04 THEN true END AS flagged_duplicate,
             sex AS patient_sex, age AS patient_onset_age, '801' AS patient_onset_age_unit,
             drug_count, reaction_count
           FROM latest""",
    ),
    "explode_drugs": _with(_CHILDREN, "SELECT id AS safetyreportid, * EXCLUDE (id) FROM drug"),
    "explode_reactions": _with(
        _CHILDREN, "SELECT id AS safetyreportid, * EXCLUDE (id) FROM reaction"
    ),
    # --- nesting
    "nest_cases": _with(_CASES, _FLAT_CASE),
    "nest_cases_from_tables": _with(_CASES, _FLAT_CASE),
    "capped_input": _with(_CASES, _FLAT_CASE + " ORDER BY id LIMIT 50"),
    # --- signals
    "pair_build": _with(_PAIRS, "SELECT id AS safetyreportid, * EXCLUDE (id) FROM pair"),
    "pair_build_from_documents": _with(
        _PAIRS, "SELECT id AS safetyreportid, * EXCLUDE (id) FROM pair"
    ),
    "pair_build_all_roles": _with(
        _PAIRS, "SELECT id AS safetyreportid, * EXCLUDE (id) FROM every_pair"
    ),
    "pair_counts": _with(_SIGNALS, "SELECT * FROM counted"),
    "prr_contingency": _with(_SIGNALS, "SELECT * FROM cells"),
    "prr_signals": _with(_SIGNALS, "SELECT * EXCLUDE (uncorrected_prr) FROM signal"),
    "prr_sparse": _with(_SIGNALS, "SELECT * FROM signal WHERE continuity_corrected"),
    "prr_top": _with(
        _SIGNALS,
        """SELECT active_substance, reaction_term, report_count, prr, meets_min_count FROM signal
           ORDER BY report_count DESC, prr DESC NULLS LAST, active_substance, reaction_term LIMIT 20""",
    ),
    # --- gates
    "gates": _with(
        _LATEST,
        _checks(
            ("row_count(>= 1)", "latest", "false", "total >= 1"),
            ("row_count(1..10)", "latest", "false", "total BETWEEN 1 AND 10"),
            ("not_null(safetyreportid)", "latest", "id IS NULL", "bad = 0"),
            ("not_null(reporter_country)", "latest", "l_discount = 0.01", "bad = 0"),
            ("null_rate(receipt_date) <= 0.05", "latest", "receipt_date IS NULL", "bad <= total * 0.05"),
            ("null_rate(receipt_date) <= 0.5", "latest", "receipt_date IS NULL", "bad <= total * 0.5"),
        ),
    ),
    "gate_unique": _with(
        _LATEST,
        """SELECT 'unique(safetyreportid)' AS "check", count(*) = count(DISTINCT id) AS passed,
             count(*) AS total, count(*) - count(DISTINCT id) AS bad, 'bronze' AS stage FROM line
           UNION ALL
           SELECT 'unique(safetyreportid,receiptdateformat)', count(*) = count(DISTINCT k),
             count(*), count(*) - count(DISTINCT k), 'bronze'
           FROM (SELECT id || '/' || coalesce(receipt_format, 'none') AS k FROM line)
           UNION ALL
           SELECT 'unique(safetyreportid)', count(*) = count(DISTINCT id), count(*),
             count(*) - count(DISTINCT id), 'latest' FROM latest""",
    ),
    "gate_ordering": _with(
        _LATEST,
        """SELECT 'ordering(receive_date <= receipt_date)' AS "check", bad = 0 AS passed, total, bad, compared
           FROM (
             SELECT count(*) AS total, count(*) FILTER (receipt_date < receive_date) AS bad,
               'day' AS compared FROM latest
             UNION ALL
             SELECT count(*), count(*) FILTER (receipt_date <
               CASE WHEN receipt_precision = 'month' THEN date_trunc('month', receive_date)::DATE
                    ELSE receive_date END), 'precision' FROM latest)""",
    ),
    "stage_stats": _with(
        _SIGNALS,
        """SELECT 'bronze_rows' AS stage, count(*) AS n FROM line
           UNION ALL SELECT 'silver_report_rows', count(*) FROM latest
           UNION ALL SELECT 'silver_drug_rows', count(*) FROM drug
           UNION ALL SELECT 'silver_reaction_rows', count(*) FROM reaction
           UNION ALL SELECT 'gold_signal_rows', count(*) FROM signal
           UNION ALL SELECT 'enrichment_input_rows', count(*) FROM latest""",
    ),
    "run_chain": _with(
        _SIGNALS
        + """,
           judged AS (
             SELECT seriousness AS actual, id IN (SELECT id FROM reaction WHERE reaction_outcome IN
               ('fatal', 'recovered_with_sequelae', 'not_recovered')) AS grave
             FROM latest)""",
        """SELECT 'landed' AS stage, count(*) AS n FROM line
           UNION ALL SELECT 'bronze_rows', count(*) FROM line
           UNION ALL SELECT 'silver_report_rows', count(*) FROM latest
           UNION ALL SELECT 'silver_drug_rows', count(*) FROM drug
           UNION ALL SELECT 'silver_reaction_rows', count(*) FROM reaction
           UNION ALL SELECT 'gold_signal_rows', count(*) FROM signal
           UNION ALL SELECT 'enrichment_input_rows', count(*) FROM latest
           UNION ALL SELECT 'attempted', count(*) FROM latest
           UNION ALL SELECT 'enriched', count(*) FROM latest
           UNION ALL SELECT 'dead_lettered', 0
           UNION ALL SELECT 'n_scored', count(actual) FROM judged
           UNION ALL SELECT 'n_unlabeled', count(*) - count(actual) FROM judged
           UNION ALL SELECT 'tp', count(*) FILTER (actual = 'serious' AND grave) FROM judged
           UNION ALL SELECT 'fp', count(*) FILTER (actual <> 'serious' AND grave) FROM judged
           UNION ALL SELECT 'tn', count(*) FILTER (actual <> 'serious' AND NOT grave) FROM judged
           UNION ALL SELECT 'fn', count(*) FILTER (actual = 'serious' AND NOT grave) FROM judged""",
    ),
    # --- evaluation
    "confusion": _with(_ENRICHED, "SELECT tp, fp, tn, fn FROM matrix"),
    "classification_metrics": _with(
        _ENRICHED,
        """SELECT n, tp, fp, tn, fn, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision,
             round(recall, 4) AS recall, round(specificity, 4) AS specificity, round(f1, 4) AS f1
           FROM rate""",
    ),
    "majority_baseline": _with(
        _ENRICHED,
        "SELECT majority_class, round(majority_accuracy, 4) AS majority_accuracy FROM majority",
    ),
    "cohens_kappa": _with(_ENRICHED, "SELECT round(cohens_kappa, 4) AS cohens_kappa FROM kappa"),
    "calibration": _with(
        _ENRICHED,
        """SELECT CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2
                  ELSE 3 END AS conf_rank,
             coalesce(confidence, 'unknown') AS confidence, count(*) AS n,
             count(*) FILTER (actual = predicted) AS correct,
             round(count(*) FILTER (actual = predicted) / count(*), 4) AS accuracy
           FROM scored GROUP BY ALL""",
    ),
    "grounding_check": _with(
        _ENRICHED,
        "SELECT checked, invented, abstained, round(invented / checked, 4) AS rate FROM grounded",
    ),
    "grounding_examples": _with(
        _ENRICHED,
        """SELECT id AS safetyreportid, suspect AS predicted,
             array_to_string(list_sort([upper(source), upper(lang)]), ';') AS available
           FROM enriched
           WHERE suspect IS NOT NULL AND suspect NOT IN (upper(source), upper(lang))
           ORDER BY id LIMIT 5""",
    ),
    "latency_percentiles": _with(
        _ENRICHED,
        "SELECT " + ", ".join(f"{_percentile(p)} AS p{p}" for p in (0, 1, 25, 50, 75, 95, 99, 100)),
    ),
    "eval_report": _with(
        _ENRICHED,
        f"""SELECT 'model-a' AS model_id, 'v1' AS prompt_version, n AS n_scored,
              (SELECT count(*) FROM enriched) - n AS n_unlabeled, tp, fp, tn, fn,
              round(accuracy, 4) AS accuracy, round(precision, 4) AS precision,
              round(recall, 4) AS recall, round(specificity, 4) AS specificity, round(f1, 4) AS f1,
              (SELECT round(cohens_kappa, 4) FROM kappa) AS cohens_kappa, majority_class,
              round(majority_accuracy, 4) AS majority_accuracy,
              round(accuracy - majority_accuracy, 4) AS lift_over_baseline,
              accuracy > majority_accuracy AS beats_baseline, checked, invented, abstained,
              round(invented / checked, 4) AS unsupported_rate,
              {_percentile(50)} AS p50_latency_ms, {_percentile(95)} AS p95_latency_ms,
              (SELECT sum(n_chars)::BIGINT FROM enriched) AS input_tokens,
              (SELECT sum(n_lines)::BIGINT FROM enriched) AS output_tokens
            FROM rate, majority, grounded""",
    ),
    # --- assessment
    "assess_rules": _with(
        _CASES
        + """,
           facts AS (
             SELECT id, text,
               coalesce(list_has_any(list_transform(reactions, lambda x: x.reaction_outcome),
                 ['fatal', 'recovered_with_sequelae', 'not_recovered']), false) AS grave,
               list_distinct(list_filter(list_transform(list_filter(drugs,
                 lambda x: x.drug_role = 'suspect'), lambda x: x.active_substance),
                 lambda x: x IS NOT NULL)) AS suspects,
               list_filter(list_transform(reactions, lambda x: x.reaction_term), lambda x: x IS NOT NULL) AS terms
             FROM rendered
           ), replied AS (
             SELECT *, CASE WHEN grave THEN 'serious' ELSE 'non_serious' END AS seriousness,
               CASE WHEN len(suspects) = 1 THEN suspects[1] END AS primary_suspect,
               coalesce(terms, []) AS key_reactions,
               CASE WHEN grave THEN 'high' WHEN len(terms) > 0 THEN 'medium' ELSE 'low' END AS confidence
             FROM facts
           )""",
        """SELECT id AS safetyreportid, ceil(length(text) / 4)::BIGINT AS input_tokens,
             ceil(length('{"seriousness":"' || seriousness || '",' ||
               coalesce('"primary_suspect":"' || primary_suspect || '",', '') || '"key_reactions":' ||
               to_json(key_reactions)::VARCHAR || ',"confidence":"' || confidence ||
               '","rationale":"' || CASE WHEN grave THEN 'A reported outcome is grave.'
               ELSE 'No reported outcome is grave.' END || '"}') / 4)::BIGINT AS output_tokens,
             0 AS latency_ms, seriousness, primary_suspect,
             len(key_reactions)::INT AS key_reaction_count, confidence
           FROM replied""",
    ),
    "assess_calls": _with(
        _REPLIES
        + """,
           seen AS (
             SELECT id, 'CASE' || chr(10) || chr(10) ||
               'Patient: age ' || printf('%g', n_chars::DOUBLE) || chr(10) ||
               'Country: ' || lang || chr(10) || chr(10) || 'What happened:' || chr(10) ||
               array_to_string(list_transform(lines, lambda x: '  - ' || x), chr(10)) ||
               chr(10) || chr(10) || 'What was taken:' || chr(10) || '  - ' || source || ' (suspect)' ||
               chr(10) || chr(10) || 'Reply with one JSON object that holds your assessment of this case.' AS text
             FROM text_case)""",
        """SELECT id AS safetyreportid, sha256(text) AS reply_digest, length(text) AS input_tokens,
             len(string_split(text, chr(10)))::BIGINT AS output_tokens, 0 AS latency_ms,
             NULL::VARCHAR AS call_error
           FROM seen""",
    ),
    "validate_assessments": _with(
        _REPLIES,
        r"""SELECT id AS safetyreportid,
              CASE WHEN failed THEN 'seriousness;confidence;rationale' ELSE errors END AS errors,
              CASE WHEN failed THEN 'Throttled: src3' END AS call_error,
              CASE WHEN errors = '' THEN first_seriousness END AS seriousness,
              CASE WHEN errors = '' THEN suspect END AS primary_suspect,
              CASE WHEN errors = '' THEN len(list_filter(lines, lambda x: regexp_matches(x, '[^\s]')))::INT END
                AS key_reaction_count,
              CASE WHEN errors = '' THEN confidence END AS confidence
            FROM first_reply""",
    ),
    "retry_pass": _with(
        _REPLIES,
        """SELECT status, attempts, reason, count(*) AS n,
             sum(billed_input)::BIGINT AS billed_input_tokens,
             sum(billed_output)::BIGINT AS billed_output_tokens
           FROM outcome GROUP BY ALL""",
    ),
    "dlq_split": _with(
        _REPLIES,
        """SELECT id AS safetyreportid, CASE status WHEN 'dead' THEN 'dlq' ELSE 'assessments' END AS output,
             CASE status WHEN 'enriched' THEN suspect END AS suspect, reason,
             CASE WHEN status = 'enriched' THEN NULL WHEN failed THEN ''
               ELSE '{"primary_suspect":"' ||
                 CASE WHEN label = 'non_serious' THEN '   ' ELSE ' ' || source || ' ' END ||
                 '","key_reactions":["' || source || '","' || lang || '"],"confidence":"' || confidence ||
                 '","rationale":"' || source || ': ' || lang || '","notes":"' || rpad(source, 1500, '.') ||
                 '"}' END AS raw_response
           FROM outcome""",
    ),
    "enrich_metrics": _with(
        _REPLIES
        + """,
           counted AS (
             SELECT count(*) AS attempted,
               count(*) FILTER (hit OR status = 'enriched') AS enriched,
               count(*) FILTER (NOT hit AND status = 'dead') AS dead_lettered,
               count(*) FILTER (hit) AS cache_hits,
               count(*) FILTER (NOT hit AND attempts = 2) AS retried,
               sum(CASE WHEN hit THEN 0 ELSE billed_input END)::BIGINT AS input_tokens,
               sum(CASE WHEN hit THEN 0 ELSE billed_output END)::BIGINT AS output_tokens,
               (7 * count(*) FILTER (hit))::BIGINT AS cached_input_tokens,
               (3 * count(*) FILTER (hit))::BIGINT AS cached_output_tokens
             FROM (SELECT *, coalesce(label = 'serious', false) AS hit FROM outcome)
           ), priced AS (
             SELECT *, input_tokens / 1e6 * 1.0 + output_tokens / 1e6 * 5.0 AS cost FROM counted)""",
        """SELECT * EXCLUDE (cost), round(enriched / attempted, 4) AS success_rate,
             round(cost, 6) AS estimated_cost_usd,
             round(cost * 1000 / attempted, 4) AS cost_per_1k_records_usd
           FROM priced""",
    ),
    "cache_split": _with(
        _REPLIES,
        """SELECT id AS safetyreportid, coalesce(label = 'serious', false) AS hit,
             CASE WHEN label = 'serious' THEN 7::BIGINT END AS input_tokens,
             CASE WHEN label = 'serious' THEN 11 END AS latency_ms
           FROM reply""",
    ),
    # --- ingest
    "ingest_windows": _with(
        _EVENT_DAYS,
        """SELECT strftime(window_start, '%Y%m%d') AS first_day, strftime(window_end, '%Y%m%d') AS last_day,
             count(event_id) AS records
           FROM planned LEFT JOIN events ON ts::DATE BETWEEN window_start AND window_end
           GROUP BY ALL""",
    ),
    "window_capped": _with(
        _EVENT_DAYS,
        """SELECT event_id, user_id, window_start, window_end
           FROM planned JOIN events ON ts::DATE BETWEEN window_start AND window_end
           QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY ts, event_id) <= 500""",
    ),
    "run_manifest": _with(
        _EVENT_DAYS,
        f"""SELECT 'events' AS dataset, '2024-02-01' AS ingest_date, 'run-1' AS run_id,
              'succeeded' AS status, sum(n)::BIGINT AS record_count, count(*) AS window_count,
              sum(bits)::VARCHAR AS content_checksum,
              string_agg(n::VARCHAR, ';' ORDER BY window_start) AS window_records,
              (count(*) FILTER (n > 0))::INT AS filled_windows
            FROM (
              SELECT window_start, count(event_id) AS n,
                coalesce(sum(('0x' || left(sha256({_MANIFEST_RECORD}), 15))::BIGINT), 0) AS bits
              FROM planned LEFT JOIN events ON ts::DATE BETWEEN window_start AND window_end
              GROUP BY window_start)""",
    ),
    # --- streaming
    "stream_ingest": f"""
        SELECT event_id, user_id, event_type, value, ts::VARCHAR AS event_ts, NULL::VARCHAR AS raw_line
        FROM events WHERE event_type <> 'error'
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, {_TORN} FROM events WHERE event_type = 'error'""",
    "stream_dedup": "SELECT event_id, user_id, event_type, value, ts::VARCHAR AS event_ts FROM events",
    "stream_keyed": """
        SELECT user_id::VARCHAR AS key, to_json({'event_id': event_id, 'user_id': user_id,
          'event_type': event_type, 'value': value, 'event_ts': ts::VARCHAR})::VARCHAR AS value
        FROM events""",
    "max_offsets": """
        SELECT event_type AS topic, hour(ts)::INT AS "partition", max(event_id) AS max_offset
        FROM events GROUP BY ALL""",
    "stream_two_sources": "SELECT event_id, user_id, event_type, value, ts::VARCHAR AS event_ts FROM events",
    "publish_land": "SELECT event_id, user_id, event_type, value, ts::VARCHAR AS event_ts FROM events",
    "stream_late": """
        SELECT event_id, CASE WHEN event_id % 2 = 0 OR ts >= (
            SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 5 DAY
          THEN 'in_time' ELSE 'late' END AS kind
        FROM events""",
    "stream_to_silver": _with(
        _LATEST,
        f"""SELECT id AS safetyreportid, seriousness, drug_count, NULL::VARCHAR AS raw_line FROM latest
            UNION ALL SELECT NULL, NULL, NULL, {_TORN} FROM events WHERE event_type = 'error'""",
    ),
    "land_accounting": f"""
        WITH bounds AS (SELECT min(ts)::DATE + 3 AS start, max(ts)::DATE - 3 AS stop FROM events),
        judged AS (
          SELECT event_id, (ts::DATE - start) // 7 AS w, CASE WHEN user_id % 10 = 0 THEN 'undated'
            WHEN ts::DATE BETWEEN start AND stop THEN 'landed' ELSE 'out_of_range' END AS fate
          FROM events, bounds WHERE event_type <> 'error'),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY fate, w ORDER BY event_id) AS place FROM judged)
        SELECT event_id, NULL::VARCHAR AS raw_line,
          CASE WHEN fate = 'landed' AND place > 300 THEN 'capped' ELSE fate END AS fate
        FROM placed
        UNION ALL SELECT NULL, {_TORN}, 'broken' FROM events WHERE event_type = 'error'""",
    "land_two_ranges": f"""
        WITH readable AS (
          SELECT event_id, user_id, event_type, CASE WHEN user_id % 10 <> 0 THEN ts::DATE::VARCHAR END AS day
          FROM events WHERE event_type <> 'error'),
        ranges AS (SELECT unnest([1, 2]) AS range)
        SELECT *, NULL::VARCHAR AS raw_line, 'landed' AS fate FROM readable WHERE day IS NOT NULL
        UNION ALL SELECT *, NULL, 'out_of_range' FROM readable WHERE day IS NOT NULL
        UNION ALL SELECT readable.*, NULL, 'undated' FROM readable, ranges WHERE day IS NULL
        UNION ALL SELECT NULL, NULL, NULL, NULL, {_TORN}, 'broken' FROM events, ranges
        WHERE event_type = 'error'""",
    "stream_replays": """
        SELECT event_id, CASE WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN 'late'
            WHEN event_id % 2 = 0 OR ts >= (
              SELECT max(ts) FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0) - INTERVAL 5 DAY
            THEN 'in_time' ELSE 'late' END AS kind,
          CASE WHEN event_id % 6 <> 0 THEN ts::VARCHAR END AS event_ts
        FROM events""",
    "stream_commits": f"""
        SELECT event_id, NULL::VARCHAR AS raw_line FROM events WHERE event_type <> 'error' AND event_id % 2 = 0
        UNION ALL SELECT NULL, {_TORN} FROM events WHERE event_type = 'error' AND event_id % 2 = 0""",
    "stream_admitted": """
        SELECT c_custkey::BIGINT AS c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey,
          (row_number() OVER (ORDER BY c_custkey) - 1) // 200 AS batch
        FROM customer""",
    "publish_ordered": """
        SELECT event_id, user_id, row_number() OVER (
          PARTITION BY user_id ORDER BY event_id % 2 DESC, ts, event_id)::INT AS place
        FROM events""",
    "range_windows": """
        WITH windows AS (
          SELECT n_name, first_day, first_day + [1, 2, 3, 5, 10, 21, 45][n_nationkey % 7 + 1] - 1 AS last_day
          FROM (SELECT *, start + (n_nationkey * 13 % 60 - 15)::INT AS first_day
            FROM nation, (SELECT min(ts)::DATE AS start FROM events)))
        SELECT event_id, n_name, first_day, last_day
        FROM events JOIN windows ON ts::DATE BETWEEN first_day AND last_day""",
    "quarantine": _with(
        _LATEST,
        """SELECT id AS safetyreportid, version AS safetyreportversion, company AS companynumb,
             'report' AS output FROM latest
           UNION ALL
           SELECT id, version, company, 'quarantine' FROM typed_precision WHERE TRY_CAST(version AS INT) <= 10""",
    ),
    "cache_pruned": _with(
        _REPLIES,
        """SELECT id AS safetyreportid, 7::BIGINT AS input_tokens, 11 AS latency_ms
           FROM reply WHERE label = 'serious' AND lang = 'es' AND source = 'src1'""",
    ),
    "assess_waves": _with(
        _REPLIES,
        """SELECT id AS safetyreportid, status, attempts, reason, billed_input::BIGINT AS billed_input_tokens
           FROM outcome""",
    ),
    "price_percentiles": """
        WITH ranked AS (
          SELECT l_extendedprice AS price, row_number() OVER (ORDER BY l_extendedprice) AS r,
            count(*) OVER () AS n FROM lineitem)
        SELECT """
    + ", ".join(
        f"(SELECT price FROM ranked WHERE r = greatest(1, least(n, "
        f"round_even({p}::DOUBLE / 100 * n + 0.5, 0)))) AS p{p}"
        for p in (0, 5, 50, 95, 100)
    ),
    "validate_types": """
        SELECT doc_id::VARCHAR AS safetyreportid,
          CASE doc_id % 5 WHEN 0 THEN 'rationale' WHEN 1 THEN 'primary_suspect'
            WHEN 2 THEN 'key_reactions' WHEN 3 THEN 'key_reactions;rationale;primary_suspect'
            ELSE '' END AS errors,
          CASE doc_id % 5 WHEN 4 THEN 'A;B' END AS key_reactions
        FROM documents""",
}

# What the transform has written is what the operators give.
for _written, _same in (
    ("written_report", "report_header"),
    ("written_drugs", "explode_drugs"),
    ("written_reactions", "explode_reactions"),
    ("written_cases", "nest_cases"),
    ("written_signals", "prr_signals"),
):
    ORACLE[_written] = ORACLE[_same]
