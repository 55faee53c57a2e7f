"""SQL answers to the queries, written for DuckDB over the same tables.

Each answer is a chain of named parts; ``sql(parts, body)`` puts the chain ahead of its last
step.
"""

from __future__ import annotations

from checks.inputs import FILE_NAME, FILE_RESULT, MEDICINES, RANGES, RAW, TESTS, UNITS
from checks.queries import AGE, CUT_NAME, DECORATED, GENDER, MEDICINE_TEXT

ORACLE: dict[str, str] = {}
NUMBER = "-?[0-9]+\\.?[0-9]*"
RANGE = f"^\\s*({NUMBER})\\s*-\\s*({NUMBER})\\s*$"
WORDS = ("('negative','positive','normal','nil','present','absent','abnormal','clear',"
         "'pale yellow','trace','pending','n/a','na','nill')")


def sql(parts: list[str], body: str) -> str:
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" + body) if parts else body


def values(rows: list[tuple], names: str) -> str:
    def lit(v) -> str:
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        if isinstance(v, list):
            return "[" + ", ".join(lit(x) for x in v) + "]"
        if isinstance(v, float):
            return f"CAST({v} AS DOUBLE)"
        return str(v) if isinstance(v, int) else "'" + v + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({names}))"


RAW_PART = "raw AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in RAW.items()) + " FROM events)"


def norm(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({x}), '\\([^)]*\\)', '', 'g'), "
            f"'[^a-z0-9+/]+', ' ', 'g'))")


def parsed(source: str, text: str, name: str = "parsed") -> list[str]:
    """``name``: source rows with the number, flag and shape of their result text."""
    return [
        f"""{name}_0 AS (SELECT *, trim({text}) AS t, lower(trim({text})) AS low,
            upper(regexp_extract(trim({text}), '(?i)^([HL])\\b', 1)) AS fl FROM {source})""",
        f"""{name}_1 AS (SELECT *, CASE WHEN fl <> '' THEN trim(substring(t, 2)) ELSE t END AS body,
            coalesce(low IN {WORDS} OR replace(low, ' ', '') IN {WORDS}, false) AS is_word,
            coalesce(regexp_matches(t, '{RANGE}'), false) AS is_range FROM {name}_0)""",
        f"""{name}_2 AS (SELECT *, coalesce(t <> '' AND NOT is_word AND NOT is_range, false) AS plain,
            regexp_extract(body, '{NUMBER}') AS num FROM {name}_1)""",
        f"""{name} AS (SELECT *, CASE WHEN plain AND num <> '' THEN CAST(num AS DOUBLE) END AS value,
            CASE WHEN plain THEN nullif(fl, '') END AS flag,
            CASE WHEN plain AND num <> '' THEN nullif(trim(
              regexp_extract(body, '(?s)^(.*?){NUMBER}(.*)$', 1) ||
              regexp_extract(body, '(?s)^(.*?){NUMBER}(.*)$', 2)), '') END AS residual_unit,
            plain AND num <> '' AS is_numeric,
            coalesce(t <> '' AND NOT is_word AND is_range, false) AS contradictory FROM {name}_2)""",
    ]


def bounds(text: str) -> tuple[str, str]:
    return tuple(f"TRY_CAST(nullif(regexp_extract(trim({text}), '{RANGE}', {i}), '') AS DOUBLE)"
                 for i in (1, 2))


# ---- dictionaries -----------------------------------------------------------------------

DIM_PARTS = [
    "dict AS " + values(TESTS, "ord, canonical, value_type, unit, aliases"),
    f"""pool AS (SELECT ord, canonical, u.i AS i, {norm('u.x')} AS alias_norm FROM (
        SELECT ord, canonical, unnest(list_transform(list_prepend(canonical, aliases),
          lambda x, k: {{'x': x, 'i': k}})) AS u FROM dict))""",
    """alias AS (SELECT alias_norm, arg_max(canonical, ord * 1000 + i) AS canonical,
        min(ord * 1000 + i) AS pool_ord, arg_min(canonical, ord * 1000 + i) AS first_canonical
        FROM pool WHERE alias_norm <> '' GROUP BY alias_norm)""",
    """tests AS (SELECT canonical, arg_max(coalesce(unit, '-'), ord) AS u, arg_max(value_type, ord)
        AS value_type FROM dict GROUP BY canonical)""",
    "ranges AS " + values(RANGES, "canonical, cfg_low, cfg_high, outlier_low, outlier_high"),
    "units AS " + values(UNITS, "unit_key, unit_to, factor"),
]


def match_parts(threshold: float = 0.9) -> list[str]:
    """``name_map`` from ``names(name_norm)`` and ``alias``: every tier by direct comparison.

    The ratio is found by its definition: the longest common block (first in a, then in b),
    then the same to its left and to its right.
    """
    def ratio(name: str, pairs: str) -> list[str]:
        return [
            f"""{name}_st AS (
              SELECT a, b, 1 AS alo, length(a) + 1 AS ahi, 1 AS blo, length(b) + 1 AS bhi,
                CAST(0 AS BIGINT) AS got, CAST(0 AS BIGINT) AS lvl FROM {pairs}
              UNION ALL
              SELECT a, b, nx.alo, nx.ahi, nx.blo, nx.bhi, nx.got, lvl + 1 FROM (
                SELECT a, b, lvl, unnest([
                  {{'alo': alo, 'ahi': -m[2], 'blo': blo, 'bhi': -m[3], 'got': m[1]}},
                  {{'alo': -m[2] + m[1], 'ahi': ahi, 'blo': -m[3] + m[1], 'bhi': bhi, 'got': 0}}]) AS nx
                FROM (SELECT *, list_max(flatten(list_transform(range(alo, ahi), lambda i:
                    list_transform(range(blo, bhi), lambda j:
                      [len(list_filter(range(1, least(ahi - i, bhi - j) + 1), lambda n:
                        substr(a, i, n) = substr(b, j, n))), -i, -j])))) AS m
                  FROM {name}_st WHERE alo < ahi AND blo < bhi) WHERE m[1] > 0))""",
            f"""{name} AS (SELECT a, b, 2.0 * sum(got) / (length(a) + length(b)) AS r
              FROM {name}_st GROUP BY a, b)""",
        ]

    return [
        "rest AS (SELECT DISTINCT name_norm FROM names WHERE name_norm NOT IN (SELECT alias_norm FROM alias))",
        f"""near AS (SELECT alias_norm AS a, name_norm AS b FROM rest JOIN alias ON
            2.0 * least(length(alias_norm), length(name_norm)) /
            (length(alias_norm) + length(name_norm)) >= {threshold})""",
        *ratio("fwd", "near"),
        f"accepted AS (SELECT a, b, r FROM fwd WHERE r >= {threshold})",
        "swapped AS (SELECT b AS a, a AS b FROM accepted)",
        *ratio("rev", "swapped"),
        """similar_best AS (SELECT x.b AS name_norm, arg_max(x.a, [x.r::VARCHAR, x.a]) AS alias_norm,
            max(x.r) AS score FROM accepted x GROUP BY x.b)""",
        """similar_map AS (SELECT s.name_norm, s.alias_norm, al.canonical, s.score,
            round_even(rev.r, 3) AS confidence FROM similar_best s JOIN alias al USING (alias_norm)
            JOIN rev ON rev.a = s.name_norm AND rev.b = s.alias_norm)""",
        """suffix_map AS (SELECT name_norm, arg_min(first_canonical, pool_ord) AS canonical
            FROM names JOIN alias ON ends_with(alias_norm, name_norm) AND alias_norm <> name_norm
            AND length(name_norm) >= 4 AND length(name_norm) >= 0.75 * length(alias_norm)
            GROUP BY name_norm)""",
        """prefix_map AS (SELECT name_norm, arg_min(first_canonical, pool_ord) AS canonical
            FROM names JOIN alias ON starts_with(alias_norm, name_norm) AND alias_norm <> name_norm
            AND length(name_norm) >= 6 AND length(name_norm) >= 0.55 * length(alias_norm)
            GROUP BY name_norm)""",
        """name_map AS (SELECT n.name_norm,
            coalesce(e.canonical, s.canonical, x.canonical, p.canonical) AS canonical,
            CASE WHEN e.canonical IS NOT NULL THEN 'exact_alias_match'
              WHEN s.canonical IS NOT NULL THEN 'fuzzy_match'
              WHEN x.canonical IS NOT NULL THEN 'suffix_match_truncated_name'
              WHEN p.canonical IS NOT NULL THEN 'prefix_match_truncated_name'
              ELSE 'unresolved' END AS method,
            CASE WHEN e.canonical IS NOT NULL THEN 1.0::DOUBLE
              WHEN s.canonical IS NOT NULL THEN s.confidence
              WHEN x.canonical IS NOT NULL OR p.canonical IS NOT NULL THEN 0.99::DOUBLE
              ELSE 0.0::DOUBLE END AS confidence
            FROM (SELECT DISTINCT name_norm FROM names) n
            LEFT JOIN alias e ON e.alias_norm = n.name_norm
            LEFT JOIN similar_map s USING (name_norm)
            LEFT JOIN suffix_map x ON x.name_norm = n.name_norm
            LEFT JOIN prefix_map p ON p.name_norm = n.name_norm)""",
    ]


def measured(source: str, name: str = "measured", *, reported_first: bool = False,
             converted: bool = False) -> list[str]:
    """``name``: rows of ``source`` (parsed, with ``canonical``, ``unit``, ``range_text``)
    converted and classified."""
    lo, hi = bounds("range_text")
    low = "coalesce(rlow, cfg_low)" if reported_first else "cfg_low"
    high = "coalesce(rhigh, cfg_high)" if reported_first else "cfg_high"
    v = "result_value" if converted else "value"
    return [
        f"""{name}_0 AS (SELECT s.*, nullif(ts.u, '-') AS unit_expected,
            coalesce(ts.value_type, 'text') AS value_type,
            rg.cfg_low, rg.cfg_high, rg.outlier_low, rg.outlier_high,
            coalesce(u1.unit_key, u2.unit_key) IS NOT NULL AS unit_known,
            CASE WHEN u1.unit_key IS NOT NULL THEN u1.unit_to ELSE u2.unit_to END AS unit_to,
            coalesce(u1.factor, u2.factor, 1.0) AS factor,
            {lo} AS lo0, {hi} AS hi0
            FROM {source} s LEFT JOIN tests ts ON ts.canonical = s.canonical
            LEFT JOIN ranges rg ON rg.canonical = s.canonical
            LEFT JOIN units u1 ON u1.unit_key = trim(coalesce(s.unit, ''))
            LEFT JOIN units u2 ON u2.unit_key = lower(trim(coalesce(s.unit, ''))))""",
        f"""{name}_1 AS (SELECT *, value * factor AS result_value,
            CASE WHEN hi0 IS NOT NULL THEN lo0 END AS rlow, CASE WHEN lo0 IS NOT NULL THEN hi0 END AS rhigh,
            CASE WHEN unit_known THEN coalesce(nullif(unit_to, ''), unit_expected)
              ELSE coalesce(nullif(unit_expected, ''), nullif(unit, '')) END AS unit_canonical
            FROM {name}_0)""",
        f"""{name} AS (SELECT *, coalesce(rlow, cfg_low) AS range_low, coalesce(rhigh, cfg_high) AS range_high,
            CASE WHEN rlow IS NOT NULL THEN 'source_reported' WHEN cfg_low IS NOT NULL
              THEN 'reference_config' END AS range_source,
            coalesce(value_type <> 'text' AND unit_canonical <> unit_expected, false) AS exclude,
            CASE WHEN value_type = 'text' THEN 'Not Applicable'
              WHEN unit_canonical <> unit_expected THEN 'Invalid'
              WHEN contradictory THEN 'Invalid'
              WHEN NOT is_numeric AND coalesce(t, '') = '' THEN 'Unclassified'
              WHEN NOT is_numeric THEN 'Invalid'
              WHEN outlier_low IS NULL THEN 'Unclassified'
              WHEN {v} < outlier_low OR {v} > outlier_high THEN 'Outlier'
              WHEN {v} < {low} THEN 'Below Range'
              WHEN {v} > {high} THEN 'Above Range' ELSE 'Within Range' END AS status
            FROM {name}_1)""",
    ]


NAMED = [
    RAW_PART, *DIM_PARTS,
    f"names AS (SELECT DISTINCT {norm('raw_name')} AS name_norm FROM raw)",
    *match_parts(),
    f"""named AS (SELECT r.*, m.canonical, m.method, m.confidence FROM raw r
        LEFT JOIN name_map m ON m.name_norm = {norm('r.raw_name')})""",
    *parsed("named", "result"),
]
CLASSIFIED = [*NAMED, *measured("parsed")]

# ---- scalars ----------------------------------------------------------------------------

ORACLE["parse_numeric"] = sql(
    [RAW_PART, *parsed("raw", "result")],
    """SELECT event_id, value, flag, residual_unit, is_numeric, contradictory, result AS raw
       FROM parsed""")
_lo, _hi = bounds("range_text")
ORACLE["parse_range"] = sql([RAW_PART], f"SELECT event_id, {_lo} AS low, {_hi} AS high FROM raw")
COMPOSITE = "([A-Za-z][A-Za-z0-9 /().,&+\\-]*?)\\s*-\\s*([0-9.]+)"
_parts = lambda text: (
    f"CASE WHEN contains({text}, ',') AND len(regexp_extract_all({text}, '{COMPOSITE}', 1)) >= 2 "
    f"THEN list_transform(regexp_extract_all({text}, '{COMPOSITE}', 1), lambda x, k: "
    f"{{'name': trim(x, ' ,'), 'value': regexp_extract_all({text}, '{COMPOSITE}', 2)[k], "
    f"'ord': CAST(k - 1 AS INTEGER)}}) END")
ORACLE["split_composite"] = sql([RAW_PART], f"""SELECT event_id, p.ord AS part_no, p.name, p.value
    FROM (SELECT event_id, unnest({_parts('result')}) AS p FROM raw)""")


def exploded(source: str, name: str, result: str, out: str) -> str:
    return f"""{out} AS (SELECT * EXCLUDE (p), p.ord AS sub_ord, p.name AS sub_name, p.value AS sub_result
        FROM (SELECT *, unnest(coalesce({_parts(result)},
          [{{'name': {name}, 'value': {result}, 'ord': CAST(0 AS INTEGER)}}])) AS p FROM {source}))"""


ORACLE["composite_explode"] = sql(
    [RAW_PART, exploded("raw", "raw_name", "result", "x")],
    """SELECT event_id, sub_ord, sub_name AS test_name_original, sub_result AS result_text,
       result AS result_text_original, unit, range_text, page FROM x""")

_age = "(?i)^(?:([0-9]+)\\s*Y)?\\s*(?:([0-9]+)\\s*M)?\\s*(?:([0-9]+)\\s*D)?"
ORACLE["parse_age"] = sql([
    f"a AS (SELECT event_id, trim({AGE}) AS t FROM events)",
    f"""b AS (SELECT *, regexp_extract(t, '{_age}', 1) AS y, regexp_extract(t, '{_age}', 2) AS m,
        regexp_extract(t, '{_age}', 3) AS d, regexp_full_match(t, '[0-9]+(\\.[0-9]+)?') AS yrs,
        t <> '' AND upper(t) NOT IN ('[AGE REDACTED]', 'N/A', 'NA') AS ok FROM a)""",
    "c AS (SELECT *, ok AND NOT yrs AND y || m || d <> '' AS comp FROM b)"],
    """SELECT event_id, nullif(t, '') AS age_text,
       CASE WHEN ok AND yrs THEN CAST(t AS DOUBLE) WHEN comp THEN CAST(coalesce(nullif(y, ''), '0') AS DOUBLE)
         END AS age_years,
       CASE WHEN comp THEN CAST(coalesce(nullif(m, ''), '0') AS DOUBLE) END AS age_months,
       CASE WHEN comp THEN CAST(coalesce(nullif(d, ''), '0') AS DOUBLE) END AS age_days FROM c""")
ORACLE["normalise_gender"] = f"""SELECT c_custkey, CASE
    WHEN lower(trim(g)) = '' OR contains(lower(g), 'redacted') THEN NULL
    WHEN lower(trim(g)) IN ('m', 'male', 'man') THEN 'Male'
    WHEN lower(trim(g)) IN ('f', 'female', 'woman') THEN 'Female'
    WHEN lower(trim(g)) IN ('o', 'other', 'trans') THEN 'Other' ELSE g END AS gender
    FROM (SELECT c_custkey, {GENDER} AS g FROM customer)"""
ORACLE["parse_date"] = """SELECT o_orderkey, CAST(coalesce(
      CASE WHEN o_orderkey % 2 = 0 THEN try_strptime(t, '%d/%m/%Y') ELSE try_strptime(t, '%m/%d/%Y') END,
      try_strptime(t, '%d/%m/%Y'), try_strptime(t, '%m/%d/%Y'), try_strptime(t, '%Y-%m-%d'),
      try_strptime(t, '%d-%m-%Y'), try_strptime(t, '%d.%m.%Y'), try_strptime(t, '%d-%b-%Y'),
      try_strptime(t, '%d/%b/%Y'), try_strptime(t, '%d-%B-%Y')) AS DATE) AS parsed
    FROM (SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 3 THEN strftime(o_orderdate, '%-d-%-m-%Y') WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y')
      WHEN 5 THEN strftime(o_orderdate, '%d-%b-%Y') WHEN 6 THEN strftime(o_orderdate, '%-d/%b/%Y')
      WHEN 7 THEN strftime(o_orderdate, '%d-%B-%Y') ELSE '31/02/1999' END AS t FROM orders)"""
ORACLE["normalise_name"] = f"SELECT p_partkey, {norm(DECORATED)} AS name_norm FROM part"
ORACLE["normalise_text"] = f"SELECT doc_id, {norm('text')} AS norm FROM documents"
_plain = ("CASE WHEN abs({v}) >= 1e7 THEN regexp_replace(CAST(CAST({v} AS DECIMAL(38,6)) AS VARCHAR), "
          "'(\\.[0-9]+?)0+$', '\\1') ELSE CAST({v} AS VARCHAR) END")
ORACLE["display_values"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_linenumber % 3 <> 0 THEN {_plain.format(v='v')} ELSE l_returnflag END AS shown,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS VARCHAR) || '-' || {_plain.format(v='v')}
      ELSE l_linestatus END AS range_shown
    FROM (SELECT *, l_extendedprice * 1000 AS v FROM lineitem)"""
ORACLE["row_id"] = sql([RAW_PART], """SELECT event_id, sha256(concat_ws('|', CAST(doc AS VARCHAR),
    'lab_test', raw_name, result, unit)) AS id FROM raw""")
ORACLE["content_hash"] = """SELECT doc_id, sha256('{"inner":{"body":{"text":' || to_json(text) ||
    '},"n":' || n_chars || '},"lang":"' || lang ||
    '","source":"' || source || '"}') AS hash FROM documents"""
ORACLE["document_key"] = """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 = 0
    THEN sha256(source || '|' || lang) WHEN doc_id % 3 <> 0 THEN sha256(source)
    WHEN doc_id % 2 = 0 THEN sha256(lang) ELSE 'none' END AS key FROM documents"""
ORACLE["severity_classes"] = sql(CLASSIFIED, """SELECT event_id,
    CASE status WHEN 'Outlier' THEN 0 WHEN 'Invalid' THEN 1 ELSE 2 END AS severity,
    CASE status WHEN 'Outlier' THEN 'pill-outlier' WHEN 'Invalid' THEN 'pill-invalid'
      WHEN 'Above Range' THEN 'pill-above' WHEN 'Below Range' THEN 'pill-below'
      WHEN 'Within Range' THEN 'pill-within' WHEN 'Not Applicable' THEN 'pill-na'
      ELSE 'pill-unclassified' END AS display_class FROM measured""")

# ---- JSON mapping -----------------------------------------------------------------------

ORACLE["path_extract"] = """SELECT event_id, CASE event_id % 4
    WHEN 0 THEN json_extract_string(props, '$.k') WHEN 3 THEN replace(props, ' ', '') END AS found,
    event_id % 4 <> 2 AS present FROM events"""
ORACLE["meta_map"] = """SELECT c_custkey, CAST(2 AS INTEGER) AS n, c_name AS claim_no,
    c_mktsegment AS nt_code FROM customer"""
ORACLE["flatten_values"] = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || '; ' || lang
    WHEN 1 THEN '{"source":"' || source || '"}' WHEN 2 THEN NULL
    ELSE CAST(n_chars AS VARCHAR) END AS flat FROM documents"""
ORACLE["malformed_json"] = """SELECT event_id, CASE WHEN NOT json_valid(b) THEN 'malformed_json' END AS reason,
    CASE WHEN json_valid(b) THEN CAST(json_extract(b, '$.k') AS BIGINT) END AS k FROM (
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1)
      ELSE props END AS b FROM events)"""
ORACLE["shape_check"] = "SELECT event_id, event_id % 3 <> 0 AS shape_ok FROM events"
ORACLE["unknown_source"] = """SELECT doc_id, source, CASE WHEN length(source) <> 4
    THEN 'unknown_clinic' END AS reason FROM documents"""

# ---- matching ---------------------------------------------------------------------------

PART_MATCH = [
    f"part_raw AS (SELECT p_partkey, {CUT_NAME} AS raw_name FROM part)",
    "dict AS (SELECT min(p_partkey) AS ord, p_name AS canonical FROM part GROUP BY p_name)",
    """alias AS (SELECT canonical AS alias_norm, canonical, ord * 2 AS pool_ord,
        canonical AS first_canonical FROM dict UNION ALL
        SELECT canonical || ' unit', canonical, ord * 2 + 1, canonical FROM dict)""",
    f"names AS (SELECT DISTINCT {norm('raw_name')} AS name_norm FROM part_raw)",
    *match_parts(),
]
ORACLE["match_exact"] = sql(PART_MATCH, """SELECT name_norm, canonical FROM names
    JOIN alias ON alias_norm = name_norm""")
ORACLE["match_suffix"] = sql(PART_MATCH, "SELECT name_norm, canonical FROM suffix_map")
ORACLE["match_prefix"] = sql(PART_MATCH, "SELECT name_norm, canonical FROM prefix_map")
ORACLE["match_tiered"] = sql(PART_MATCH, f"""SELECT p_partkey, canonical, method, confidence
    FROM part_raw JOIN name_map ON name_norm = {norm('raw_name')}""")
# The query runs this tier over every name, also those an alias equals.
ORACLE["match_similar_ratio"] = sql(
    [p.replace(" WHERE name_norm NOT IN (SELECT alias_norm FROM alias)", "") for p in PART_MATCH],
    """SELECT name_norm, alias_norm, canonical, round(score, 6) AS score, confidence
       FROM similar_map""")


def medicine(x: str) -> str:
    s = f"lower({x})"
    s = f"regexp_replace({s}, '\\b\\d+\\s*(mg|ml|mcg|g)\\b', '', 'g')"
    s = f"regexp_replace({s}, '\\b(tab|tablet|inj|injection|cap|capsule|syrup)\\b', '', 'g')"
    return f"trim(regexp_replace({s}, '[^a-z]+', ' ', 'g'))"


MEDICINE_PARTS = [
    "meds AS " + values(MEDICINES, "ord, generic_name, drug_class, brands"),
    f"""med_dim AS (SELECT {medicine('b')} AS med_norm, generic_name, drug_class,
        {medicine('b')} = {medicine('generic_name')} AS is_generic FROM (
        SELECT generic_name, drug_class, unnest(list_append(brands, generic_name)) AS b FROM meds))""",
    """med_index AS (SELECT med_norm, any_value(generic_name) AS gname, any_value(drug_class) AS gclass,
        bool_or(is_generic) AS is_generic FROM med_dim GROUP BY med_norm)""",
]
MED_COLUMNS = """CASE WHEN coalesce(medicine, '') <> '' THEN coalesce(gname, medicine) END AS generic_name,
    CASE WHEN coalesce(medicine, '') <> '' THEN gclass END AS drug_class,
    CASE WHEN coalesce(medicine, '') = '' THEN 'missing' WHEN is_generic THEN 'generic_confirmed'
      WHEN gname IS NOT NULL THEN 'brand_resolved' ELSE 'unmapped_brand_or_generic' END AS medicine_type"""
ORACLE["medicine_map"] = sql(MEDICINE_PARTS, f"""SELECT p_partkey, medicine, {MED_COLUMNS}
    FROM (SELECT p_partkey, {MEDICINE_TEXT} AS medicine FROM part)
    LEFT JOIN med_index ON med_norm = {medicine('medicine')}""")

# ---- units, ranges, classification ------------------------------------------------------

ORACLE["test_attributes"] = sql(NAMED, """SELECT event_id, n.canonical, nullif(ts.u, '-') AS unit_expected,
    ts.value_type FROM named n LEFT JOIN tests ts ON ts.canonical = n.canonical""")
ORACLE["unit_convert"] = sql(CLASSIFIED, "SELECT event_id, result_value, unit_canonical FROM measured")
ORACLE["range_fallback"] = sql(CLASSIFIED, "SELECT event_id, range_low, range_high, range_source FROM measured")
ORACLE["classify"] = sql(CLASSIFIED, "SELECT event_id, status, exclude FROM measured")
ORACLE["classify_reported"] = sql(
    [*NAMED, *measured("parsed", reported_first=True, converted=True)],
    "SELECT event_id, status FROM measured")
ORACLE["excluded_rows"] = sql(CLASSIFIED, """SELECT event_id, canonical, unit_canonical,
    'unit mismatch: ''' || canonical || ''' expects ''' || unit_expected ||
    ''' but this row reported ''' || unit_canonical || '''' AS reason FROM measured WHERE exclude""")
ORACLE["status_breakdown"] = sql(CLASSIFIED, """SELECT status AS test_analytics, count(*) AS c
    FROM measured WHERE NOT exclude GROUP BY status""")

# ---- dedup ------------------------------------------------------------------------------

_resub = """d AS (SELECT doc_id, concat_ws('-', source, n_chars) AS k, text AS h FROM documents)"""
ORACLE["file_dedup_first_round"] = sql([_resub], """SELECT doc_id FROM (SELECT doc_id,
    row_number() OVER (PARTITION BY k ORDER BY doc_id) AS a,
    row_number() OVER (PARTITION BY h ORDER BY doc_id) AS b FROM d) WHERE a = 1 AND b = 1""")


def walk(source: str, order: str, lane: str) -> list[str]:
    """The pass itself: one document per step and lane, in order, remembering the keys and
    contents kept so far. Documents of different lanes share nothing; a value that occurs once
    need not be remembered."""
    return [
        f"""n AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY o) AS i FROM (
            SELECT {order} AS o, {lane} AS lane, k, h, count(*) OVER (PARTITION BY k) > 1 AS kk,
              count(*) OVER (PARTITION BY h) > 1 AS hh FROM {source}))""",
        """walk AS (SELECT DISTINCT lane, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS o, false AS kept,
              CAST([] AS VARCHAR[]) AS ks, CAST([] AS VARCHAR[]) AS hs FROM n
            UNION ALL
            SELECT lane, i, o, NOT dup, CASE WHEN dup OR NOT kk THEN ks ELSE list_append(ks, k) END,
              CASE WHEN dup OR NOT hh THEN hs ELSE list_append(hs, h) END
            FROM (SELECT n.*, ks, hs, list_contains(ks, k) OR list_contains(hs, h) AS dup
              FROM walk JOIN n ON n.i = walk.i + 1 AND n.lane = walk.lane))""",
    ]


_resub_short = _resub.replace("text AS h", "md5(text) AS h")
ORACLE["file_dedup_greedy"] = sql([_resub_short, *walk("d", "doc_id", "0")],
                                  "SELECT o AS doc_id FROM walk WHERE kept")
ORACLE["file_dedup_chains"] = sql([
    """d AS (SELECT o_orderkey, o_custkey % 50 AS lane, CAST(o_custkey AS VARCHAR) AS k,
        CAST(CAST(floor(o_totalprice / 20000) AS INTEGER) AS VARCHAR) || '-' || o_custkey % 50 AS h
        FROM orders)""", *walk("d", "o_orderkey", "lane")],
    "SELECT o AS o_orderkey FROM walk WHERE kept")
ORACLE["repeat_flag"] = sql([RAW_PART], """SELECT event_id, rn > 1 AS repeated, CASE WHEN rn > 1 THEN
    'repeats the value on page ' || p || ' of this document'
    END AS note FROM (SELECT event_id,
      row_number() OVER (PARTITION BY doc, raw_name, result ORDER BY event_id) AS rn,
      first_value(page) OVER (PARTITION BY doc, raw_name, result ORDER BY event_id) AS p FROM raw)""")
ORACLE["keep_first"] = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""
ORACLE["latest_per_key"] = """SELECT o_custkey, o_orderkey, o_orderdate FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1"""

# ---- sinks ------------------------------------------------------------------------------

ORACLE["upsert_merge"] = ORACLE["upsert_table"] = """
    SELECT o_orderkey, o_custkey, round(o_totalprice + 1, 2) AS o_totalprice, 'later' AS o_note
    FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_custkey, round(o_totalprice, 2), NULL
    FROM orders WHERE o_orderkey % 2 <> 0"""
ORACLE["reset_table"] = """SELECT o_orderkey, o_custkey, round(o_totalprice + 1, 2) AS o_totalprice,
    'later' AS o_note FROM orders WHERE o_orderkey % 2 = 0"""
ORACLE["error_log_tail"] = """SELECT 'f' || event_id AS file_path, 'c' || user_id AS clinic_id,
    date_trunc('second', ts) AS occurred_at FROM events WHERE event_type = 'error'
    ORDER BY date_trunc('second', ts) DESC, 'f' || event_id LIMIT 10"""

# ---- the whole pipeline -----------------------------------------------------------------

FILES = [
    RAW_PART,
    "docs AS (SELECT event_id // 4 AS doc_no, min(ts) AS ts FROM raw GROUP BY ALL)",
    """copies AS (SELECT *, 'a' AS kind FROM docs
        UNION ALL SELECT *, 'b' FROM docs WHERE doc_no % 7 = 0 AND doc_no % 5 < 2
        UNION ALL SELECT *, 'c' FROM docs WHERE doc_no % 13 = 0)""",
    """files AS (SELECT *, ['alpha', 'alpha', 'beta', 'gamma', 'omega'][doc_no % 5 + 1] AS clinic_id,
        strftime(ts, '%Y-%m-%d') AS date_str,
        doc_no || CASE WHEN kind = 'b' THEN '-again' ELSE '' END AS ids,
        CASE WHEN kind = 'c' THEN 'K' ELSE 'U' END || doc_no AS patient,
        CASE WHEN doc_no % 5 = 4 THEN 'unknown_clinic'
          WHEN kind = 'a' AND doc_no % 11 = 0 THEN 'malformed_json' END AS reason FROM copies)""",
    """paths AS (SELECT *, '/landing/' || clinic_id || '/' || date_str || '/' ||
        lpad(CAST(doc_no AS VARCHAR), 10, '0') || '_' || kind || '.json' AS file_path,
        CASE WHEN reason IS NULL THEN 'D-' || ids END AS document_id,
        -- a copy is a duplicate exactly when its original could be read
        reason IS NULL AND kind <> 'a' AND doc_no % 11 <> 0 AS suppressed FROM files)""",
    "good AS (SELECT * FROM paths WHERE reason IS NULL)",
    "kept AS (SELECT * FROM good WHERE NOT suppressed)",
]
ORACLE["scan_paths"] = sql(FILES, """SELECT file_path, clinic_id, date_str, reason, document_id,
    CASE WHEN reason IS NULL THEN CASE WHEN clinic_id = 'alpha' THEN 'C-' ELSE 'V-' END || ids END AS correlation_id,
    CASE WHEN reason IS NULL THEN CASE WHEN clinic_id = 'beta' THEN 'D-' ELSE 'T-' END || ids END AS trace_id,
    CASE WHEN reason IS NULL THEN true END AS shape_ok FROM paths""")
BLOCKS = """blocks AS (
    SELECT *, 'lab_report' AS record_type, CASE WHEN clinic_id = 'alpha' THEN 'bench' END AS classifier,
      0 AS block_ord FROM {src}
    UNION ALL SELECT *, 'discharge_summary', 'ward', 1 FROM {src}
      WHERE clinic_id = 'alpha' AND doc_no % 6 = 0
    UNION ALL SELECT *, NULL, 'scan', 2 FROM {src} WHERE clinic_id = 'alpha' AND doc_no % 9 = 0)"""
ALL_BLOCKS = [*FILES, BLOCKS.format(src="good")]
ORACLE["route_blocks"] = sql(ALL_BLOCKS, """SELECT clinic_id, record_type, classifier, count(*) AS n
    FROM blocks GROUP BY ALL""")
ORACLE["block_dead_letters"] = sql(ALL_BLOCKS, """SELECT file_path, clinic_id, 'block_routing' AS stage,
    'unknown_classifier' AS reason, 'classifier=''scan''' AS detail FROM blocks WHERE record_type IS NULL""")
ORACLE["map_demographics"] = sql(ALL_BLOCKS, """SELECT file_path, 'P ' || patient AS patient_name,
    patient AS uhid, CASE clinic_id WHEN 'alpha' THEN 'Male' WHEN 'beta' THEN 'Female' ELSE 'unknown' END AS gender,
    CASE WHEN clinic_id = 'alpha' THEN 'Lab' END AS hospital_name, CAST(ts AS DATE) AS bill_date,
    CASE WHEN clinic_id <> 'beta' THEN CAST(ts AS DATE) END AS reports_date,
    CASE clinic_id WHEN 'alpha' THEN (doc_no % 90) || 'Y2M' WHEN 'beta' THEN CAST(doc_no % 90 AS VARCHAR) END AS age_text,
    CASE WHEN clinic_id <> 'gamma' THEN CAST(doc_no % 90 AS DOUBLE) END AS age_years,
    CASE WHEN clinic_id = 'alpha' THEN 2.0::DOUBLE END AS age_months,
    CASE WHEN clinic_id = 'alpha' THEN 'CL-' || doc_no END AS claim_no,
    CASE WHEN clinic_id = 'alpha' THEN 'FAST' END AS source_system_reported
    FROM blocks WHERE record_type = 'lab_report'""")


def lab_lines(src: str) -> list[str]:
    return [
        f"""lines AS (SELECT f.*, r.event_id % 4 AS row_ord, r.unit, r.range_text,
            CASE WHEN f.clinic_id <> 'beta' THEN CAST(r.page AS VARCHAR) END AS page_number,
            {FILE_NAME} AS row_name, {FILE_RESULT} AS row_result
            FROM {src} f JOIN raw r ON r.event_id // 4 = f.doc_no
            WHERE NOT (f.clinic_id = 'alpha' AND r.event_id % 40 = 7))""",
        exploded("lines", "row_name", "row_result", "subs"),
    ]


ORACLE["map_test_rows"] = sql([*FILES, *lab_lines("good")], """SELECT file_path, CAST(row_ord AS INTEGER) AS row_ord,
    sub_ord, sub_name AS test_name_original, sub_result AS result_text, unit AS unit_original,
    range_text, page_number FROM subs""")
ORACLE["map_discharge"] = sql(ALL_BLOCKS, """SELECT file_path, 'P ' || patient AS patient_name,
    'Female' AS gender, CAST(ts AS DATE) AS admission_date, CAST(NULL AS DATE) AS discharge_date,
    'case ' || doc_no AS diagnosis, 'INJ A; INJ ' || doc_no AS medicine_injections_investigation,
    '[AGE REDACTED]' AS age_text, CAST(NULL AS DOUBLE) AS age_years
    FROM blocks WHERE record_type = 'discharge_summary'""")
MEDS = """meds_rows AS (SELECT b.*, m.row_ord, m.medicine, m.dose, 'BD' AS frequency FROM blocks b, LATERAL (
    VALUES (0, 'Tab. Medium 5 mg', '1'), (1, 'Standard', '2'), (2, 'Unknown ' || b.doc_no, '3')
    ) AS m(row_ord, medicine, dose) WHERE b.record_type = 'discharge_summary')"""
MED_MATCHED = f"""meds_matched AS (SELECT r.*, {MED_COLUMNS} FROM meds_rows r
    LEFT JOIN med_index ON med_norm = {medicine('r.medicine')})"""
ORACLE["map_medications"] = sql([*ALL_BLOCKS, *MEDICINE_PARTS, MEDS, MED_MATCHED],
    """SELECT file_path, CAST(row_ord AS INTEGER) AS row_ord, medicine, generic_name, drug_class,
       medicine_type, dose, frequency FROM meds_matched""")

PIPELINE = [
    *FILES, BLOCKS.format(src="kept"), *lab_lines("kept"), *DIM_PARTS,
    f"names AS (SELECT DISTINCT {norm('sub_name')} AS name_norm FROM subs)",
    *match_parts(),
    f"""named AS (SELECT s.*, m.canonical, m.method, m.confidence FROM subs s
        JOIN name_map m ON m.name_norm = {norm('sub_name')})""",
    *parsed("named", "sub_result"), *measured("parsed"),
    """flagged AS (SELECT *, coalesce(canonical, 'UNRESOLVED') AS test_name_canonical,
        row_number() OVER (PARTITION BY file_path, coalesce(canonical, 'UNRESOLVED'), sub_result
          ORDER BY row_ord, sub_ord) > 1 AS repeated FROM measured WHERE NOT exclude)""",
    *MEDICINE_PARTS, MEDS, MED_MATCHED,
    """all_rows AS (
      SELECT clinic_id, date_str, file_path, block, row_ord, sub_ord, document_id, record_type, patient_name,
        test_name_canonical, test_name_original, result_value, result_text, unit_canonical, unit_original,
        range_text, range_low, range_high, range_source, test_analytics, normalization_method,
        duplicate_within_report, page_number, medicine, generic_name, claim_no, reports_date, uhid,
        sha256(concat_ws('|', document_id, record_type, coalesce(test_name_canonical, ''),
          coalesce(CAST(result_value AS VARCHAR), result_text, ''),
          coalesce(nullif(unit_canonical, ''), nullif(unit_original, ''), '')) || tail) AS id
      FROM (
        SELECT *, 0 AS block, 'lab_test' AS record_type, 'P ' || patient AS patient_name, patient AS uhid,
          sub_name AS test_name_original, sub_result AS result_text, unit AS unit_original,
          status AS test_analytics, method AS normalization_method, repeated AS duplicate_within_report,
          CAST(NULL AS VARCHAR) AS medicine, CAST(NULL AS VARCHAR) AS generic_name, '' AS tail,
          CASE WHEN clinic_id = 'alpha' THEN 'CL-' || doc_no END AS claim_no,
          CASE WHEN clinic_id <> 'beta' THEN CAST(ts AS DATE) END AS reports_date FROM flagged
        UNION ALL BY NAME
        SELECT clinic_id, date_str, file_path, document_id, block_ord AS block, -1 AS row_ord, 0 AS sub_ord,
          record_type, 'P ' || patient AS patient_name, '' AS tail, 'CL-' || doc_no AS claim_no
        FROM blocks WHERE record_type = 'discharge_summary'
        UNION ALL BY NAME
        SELECT clinic_id, date_str, file_path, document_id, block_ord AS block, row_ord, 0 AS sub_ord,
          'medication' AS record_type, 'P ' || patient AS patient_name, medicine, generic_name,
          '|' || medicine || '|' || dose || '|' || frequency AS tail, 'CL-' || doc_no AS claim_no
        FROM meds_matched))""",
    """records AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
        ORDER BY clinic_id, date_str, file_path, block, row_ord, sub_ord) AS rn FROM all_rows) WHERE rn = 1)""",
]
ORACLE["stored_records"] = sql(PIPELINE, """SELECT file_path, id, document_id, clinic_id, record_type,
    patient_name, test_name_canonical, test_name_original, result_value, result_text, unit_canonical,
    range_low, range_high, range_source, test_analytics, normalization_method, duplicate_within_report,
    page_number, medicine, generic_name, claim_no, reports_date FROM records""")
ORACLE["suppressed_files"] = sql(FILES, """SELECT file_path, clinic_id,
    'shares_ids_or_content_with_a_kept_document' AS reason FROM good WHERE suppressed""")
ERRORS = """errors AS (
    SELECT file_path, clinic_id, 'ingestion' AS stage, reason FROM paths WHERE reason IS NOT NULL
    UNION ALL SELECT file_path, clinic_id, 'block_routing', 'unknown_classifier' FROM blocks
      WHERE record_type IS NULL
    UNION ALL SELECT file_path, clinic_id, 'unit_validation', 'unit_mismatch_excluded' FROM measured
      WHERE exclude
    UNION ALL SELECT file_path, clinic_id, 'test_name_normalisation', 'unresolved_test_name'
      FROM measured WHERE NOT exclude AND method = 'unresolved')"""
ORACLE["dead_letters"] = sql([*PIPELINE, ERRORS], """SELECT file_path, clinic_id, stage, reason,
    count(*) AS n FROM errors GROUP BY ALL""")
ORACLE["clinic_stats"] = sql(PIPELINE, """SELECT p.clinic_id, files_seen, files_failed, duplicates_suppressed,
    coalesce(rows_loaded, 0) AS rows_loaded, coalesce(unresolved_test_names, 0) AS unresolved_test_names,
    coalesce(invalid_rows, 0) AS invalid_rows, coalesce(outlier_rows, 0) AS outlier_rows,
    coalesce(within_report_duplicate_rows, 0) AS within_report_duplicate_rows
    FROM (SELECT clinic_id, count(*) AS files_seen, count(reason) AS files_failed,
      count(*) FILTER (suppressed) AS duplicates_suppressed FROM paths GROUP BY clinic_id) p
    LEFT JOIN (SELECT clinic_id, count(*) AS rows_loaded,
      count(*) FILTER (normalization_method = 'unresolved') AS unresolved_test_names,
      count(*) FILTER (test_analytics = 'Invalid') AS invalid_rows,
      count(*) FILTER (test_analytics = 'Outlier') AS outlier_rows,
      count(*) FILTER (duplicate_within_report) AS within_report_duplicate_rows
      FROM all_rows GROUP BY clinic_id) r USING (clinic_id)""")
ORACLE["run_summary"] = sql(PIPELINE, """SELECT
    (SELECT count(*) FROM paths) AS files_seen, (SELECT count(*) FROM kept) AS files_processed,
    (SELECT count(reason) FROM paths) AS files_failed,
    (SELECT count(*) FROM good WHERE suppressed) AS duplicates_suppressed,
    (SELECT count(*) FROM records) AS rows_loaded,
    (SELECT count(*) FROM all_rows WHERE test_analytics IN
      ('Outlier', 'Invalid', 'Above Range', 'Below Range')) AS rows_flagged""")
ORACLE["run_log"] = ORACLE["run_summary"]
ORACLE["stats_upsert"] = ORACLE["clinic_stats"]
ORACLE["unresolved_names"] = sql(PIPELINE, """SELECT test_name_original, count(*) AS n FROM all_rows
    WHERE normalization_method = 'unresolved' GROUP BY test_name_original""")
ORACLE["unresolved_rate"] = sql(PIPELINE, """SELECT clinic_id, CAST(date_str AS DATE) AS day, count(*) AS n,
    round(avg(CASE WHEN normalization_method = 'unresolved' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
    AS unresolved_rate FROM all_rows WHERE record_type = 'lab_test' GROUP BY ALL""")
ORACLE["quality_sketches"] = sql(PIPELINE, """SELECT clinic_id, count(*) AS n,
    count(DISTINCT document_id) AS documents, count(DISTINCT test_name_original) AS test_names,
    true AS counts_within, true AS median_within
    FROM all_rows WHERE record_type = 'lab_test' GROUP BY clinic_id""")
ORACLE["streamed_quality"] = ORACLE["quality_sketches"]
ORACLE["error_rate_daily"] = sql(FILES, """SELECT CAST(date_str AS DATE) AS day, count(*) AS seen,
    count(reason) AS failed, round(count(reason)::DOUBLE / count(*), 6) AS error_rate
    FROM paths GROUP BY date_str HAVING count(reason)::DOUBLE / count(*) > 0.01""")
ORACLE["five_column_view"] = sql(PIPELINE, """SELECT document_id, clinic_id, patient_name, uhid,
    test_name_canonical AS Test_Name, coalesce(CAST(result_value AS VARCHAR), result_text) AS Test_Name_Result,
    CASE WHEN range_low IS NOT NULL AND range_high IS NOT NULL
      THEN range_low || '-' || range_high ELSE range_text END AS Test_Name_Range,
    coalesce(unit_canonical, unit_original) AS Test_Name_Unit, test_analytics AS Test_Name_Analytics
    FROM records WHERE record_type = 'lab_test'""")
_severity = "CASE test_analytics WHEN 'Outlier' THEN 0 WHEN 'Invalid' THEN 1 ELSE 2 END"
_queue = """(test_analytics IN ('Outlier', 'Invalid', 'Above Range', 'Below Range', 'Unclassified')
    OR coalesce(duplicate_within_report, false))"""
ORACLE["flagged_queue"] = sql(PIPELINE, f"""SELECT id, document_id, test_analytics, duplicate_within_report,
    result_value FROM records WHERE {_queue} ORDER BY {_severity}, id LIMIT 300""")
ORACLE["flagged_queue_filtered"] = sql(PIPELINE, f"""SELECT id, document_id, test_analytics, clinic_id
    FROM records WHERE {_queue} AND test_analytics = 'Outlier' AND clinic_id = 'alpha'
    ORDER BY {_severity}, id LIMIT 40""")
ORACLE["flagged_queue_repeats"] = sql(PIPELINE, f"""SELECT id, document_id, duplicate_within_report
    FROM all_rows WHERE duplicate_within_report ORDER BY {_severity}, id LIMIT 300""")
ORACLE["record_search"] = sql(PIPELINE, """SELECT DISTINCT document_id, clinic_id, patient_name, uhid,
    hospital_name FROM (SELECT *, CASE WHEN clinic_id = 'alpha' AND record_type = 'lab_test'
      THEN 'Lab' END AS hospital_name FROM records)
    WHERE document_id ILIKE '%p u1%' OR uhid ILIKE '%p u1%' OR patient_name ILIKE '%p u1%'
    ORDER BY document_id, clinic_id, patient_name, uhid NULLS FIRST, hospital_name NULLS FIRST LIMIT 50""")
ORACLE["record_detail"] = sql(PIPELINE, """SELECT document_id, record_type, page_number, id, true AS raw_found
    FROM records WHERE document_id = (SELECT document_id FROM records GROUP BY document_id
      ORDER BY count(*) DESC, document_id LIMIT 1)""")
ORACLE["audit_trail"] = sql(PIPELINE, """SELECT k.file_path AS source_file, k.clinic_id, k.document_id,
    CAST(count(r.id) AS INTEGER) AS n_rows,
    arg_min(coalesce(r.test_name_original, '-'), r.block * 1000 + (r.row_ord + 1) * 10 + r.sub_ord) AS first_name
    FROM kept k LEFT JOIN all_rows r USING (file_path) GROUP BY ALL""")
ORACLE["record_types"] = sql(PIPELINE, "SELECT record_type, count(*) AS c FROM records GROUP BY record_type")
ORACLE["dashboard_status"] = sql(PIPELINE, """SELECT test_analytics, count(*) AS c FROM records
    WHERE test_analytics IS NOT NULL GROUP BY test_analytics""")
ORACLE["dashboard_totals"] = sql([*PIPELINE, ERRORS], """SELECT 'records' AS what, count(*) AS c FROM records
    UNION ALL SELECT 'errors', count(*) FROM errors""")
ORACLE["latest_run"] = """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS finished_at
    FROM orders ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) LIMIT 1"""
ORACLE["clinic_list"] = sql(PIPELINE, "SELECT DISTINCT clinic_id FROM records")
ORACLE["repeated_values"] = sql(PIPELINE, """SELECT document_id, test_name_canonical, result_text, page_number
    FROM all_rows WHERE duplicate_within_report""")
ORACLE["restatement_audit"] = sql([RAW_PART], """SELECT doc AS document_id, raw_name AS test_name_canonical,
    result AS result_text, count(DISTINCT page) AS pages FROM raw GROUP BY ALL
    HAVING count(DISTINCT page) > 1""")

# ---- streaming --------------------------------------------------------------------------

ORACLE["streamed_counts"] = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"
ORACLE["streamed_error_rate"] = """SELECT date_trunc('hour', ts) AS window_start, count(*) AS seen,
    count(*) FILTER (event_type = 'error') AS failed,
    round(count(*) FILTER (event_type = 'error')::DOUBLE / count(*), 6) AS error_rate
    FROM events GROUP BY ALL"""
ORACLE["streamed_ingest"] = sql(PIPELINE, """SELECT clinic_id, record_type, count(*) AS n FROM records
    GROUP BY ALL""")
# The second batch holds all files, so the readable ones of the first come again as copies.
ORACLE["streamed_stats"] = f"""SELECT s.clinic_id, s.files_seen + f.seen AS files_seen,
    s.files_failed + f.failed AS files_failed,
    s.duplicates_suppressed + f.seen - f.failed AS duplicates_suppressed, rows_loaded,
    unresolved_test_names, invalid_rows, outlier_rows, within_report_duplicate_rows
    FROM ({ORACLE["clinic_stats"]}) s JOIN ({sql(FILES, """SELECT clinic_id,
      count(*) FILTER (doc_no < 1000) AS seen, count(reason) FILTER (doc_no < 1000) AS failed
      FROM paths GROUP BY clinic_id""")}) f USING (clinic_id)"""
ORACLE["streamed_dead_letters"] = sql([*PIPELINE, ERRORS], """SELECT clinic_id, stage, reason, count(*) AS n,
    count(DISTINCT batch) AS batches FROM (SELECT e.clinic_id, e.stage, e.reason, unnest(
      CASE WHEN p.doc_no >= 1000 THEN [1] WHEN e.stage = 'ingestion' THEN [0, 1] ELSE [0] END) AS batch
      FROM errors e JOIN paths p USING (file_path)) GROUP BY ALL""")
ORACLE["record_search_scan"] = ORACLE["record_search"]
ORACLE["match_similar_levenshtein"] = sql(PART_MATCH[:4], """SELECT name_norm, alias_norm, canonical,
    CAST(distance AS INTEGER) AS distance, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY name_norm ORDER BY score DESC, alias_norm DESC) AS rn FROM (
        SELECT name_norm, alias_norm, canonical, levenshtein(name_norm, alias_norm) AS distance,
          1 - levenshtein(name_norm, alias_norm) / greatest(length(name_norm), length(alias_norm))::DOUBLE AS score
        FROM names, alias WHERE name_norm <> '') WHERE score >= 0.85 - 1e-9) WHERE rn = 1""")
ORACLE["replayed_records"] = ORACLE["stored_records"]
ORACLE["replayed_letters"] = ORACLE["dead_letters"]
ORACLE["replayed_stats"] = ORACLE["clinic_stats"]
