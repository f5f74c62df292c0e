"""The same laboratory tables and report stages in SQL, to compare results with."""

import re

from creamline.sources.retail import COUNTS, HUNDREDTHS, ITEMS, PARAMETERS, STATES, TESTS


class Lists:
    """The lists of the reports once more, so that a wrong one shows in the comparison."""

    OFFICIAL_REPORT_TESTS = (
        "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVPG", "MVPQVPB", "MVQVP52A", "MVPQVP8",
        "MVQVP52B", "MVQVP41",
    )
    ALERT_TESTS = (
        "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVPG", "MVPQVPB", "MVQVP52A", "MVPQVP8",
        "MVQVP52B",
    )
    RED_TAG_TESTS = (
        "MVPQVP1", "MVPQVP2", "MVPQVP6", "MVPQVP8b", "MVPQVP9", "MVPQVPAb", "MVPQVPG", "MVPQVPB",
        "MVQVP52A",
    )
    OFFICIAL_MEASURES = (
        "Bacteria Count", "Delvo Inhibitor", "Somatic cells", "Freezing point", "Analysis Temperature",
    )
    LEGACY_MEASURES = ("Bacteria Count", "Delvo Inhibitor", "Somatic cells", "Freezing point")
    COMPONENT_MEASURES = (
        "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)", "Other Solids",
        "Solids not fat (SNF)", "Somatic cells", "True Protein",
    )
    BACTERIA_MEASURES = (
        "Bacteria Count", "Bacteria Count(PI)", "Coliforms", "Delvo Inhibitor", "Pregnancy",
        "Thermoduric Plate Count", "Alkylphenolethoxylates",
    )
    CULTURE_MEASURES = (
        "Alkylphenolethoxylates", "Gram negative Bacteria", "Staphylococcus aureus",
        "Staphylococcus species", "Streptococci agalactiae", "Streptococcus species",
        "Prototheca species", "Mycoplasma species", "Bulk Tank Coliforms",
    )
    INSPECTOR_MEASURES = ("Bacteria", "Delvo Inhibitor", "Somatic cells", "Freezing point")
    INSPECTOR_WIDE_MEASURES = (
        "Bacteria", "Delvo Inhibitor", "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)",
        "Other Solids", "Solids not fat (SNF)", "Somatic cells", "True Protein",
        "Pre-incubation Count (PI)",
    )
    FEED_MEASURES = (
        "Fat", "Freezing point", "Lactose", "Milk Urea Nitrogen (MUN)", "Other Solids",
        "Solids not fat (SNF)", "Somatic cells", "True Protein", "Bacteria",
        "Pre-incubation Count (PI)", "Coliforms", "Lab Pasteurized Count",
    )
    COUNT_MEASURES = ("Bacteria", "Somatic cells")
    DOUBTFUL = "Prototheca species"
    RED_TAG_MEASURES = tuple(dict.fromkeys([*COMPONENT_MEASURES, *BACTERIA_MEASURES, *CULTURE_MEASURES]))
    SECTIONS = {
        "all": tuple(dict.fromkeys([*COMPONENT_MEASURES, *BACTERIA_MEASURES, *CULTURE_MEASURES[:-1]])),
        "components": COMPONENT_MEASURES,
        "bacteria": BACTERIA_MEASURES,
        "cultures": CULTURE_MEASURES,
    }


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _list(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


_PAR = _values((n, c, name) for n, (c, name) in enumerate(PARAMETERS.items()))
_ITEMS = _values((i, item) for i, item in enumerate(ITEMS, 1))
_STATES = _values(enumerate(STATES))
_MAP = _values(
    (item, p)
    for i, item in enumerate(ITEMS, 1)
    for n, p in enumerate(PARAMETERS)
    if (i + n) % 6
)
_TESTS = repr(list(TESTS))
_AMOUNT = "CAST(l_quantity * 30 + n * 7 AS INT)"

CTES = {
    "par": f"par(n, code, name) AS (VALUES {_PAR})",
    "items": f"items(pos, item) AS (VALUES {_ITEMS})",
    "states": f"states(pos, label) AS (VALUES {_STATES})",
    "map": f"map(item, code) AS (VALUES {_MAP})",
    "rr": f"""rr AS (
      SELECT l_orderkey * 10 + l_linenumber AS line_id,
        l_shipdate + to_hours(CAST(l_suppkey % 24 AS INT)) AS validated,
        CASE WHEN l_partkey % 4 <> 0
          THEN l_shipdate + to_hours(CAST(l_suppkey % 24 AS INT)) - INTERVAL 1 DAY END AS measured,
        CASE l_returnflag WHEN 'A' THEN 'MVPQVP1'
          WHEN 'N' THEN {_TESTS}[CAST(l_suppkey % {len(TESTS)} AS INT) + 1] ELSE 'MVPQVPX' END AS test_code,
        par.code AS param, par.name AS name,
        CASE WHEN n = 1 THEN CASE l_suppkey % 7 WHEN 1 THEN 'Positive' WHEN 2 THEN 'Not Found'
            ELSE 'NOT FOUND' END
          WHEN n IN {COUNTS!r} AND l_suppkey % 19 = 5 THEN '>3000'
          WHEN n = 3 AND l_suppkey % 13 = 0 THEN ''
          WHEN n = 14 AND l_suppkey % 3 = 0 THEN ''
          WHEN n = 4 THEN CAST({_AMOUNT} % 10 AS VARCHAR)
          WHEN n IN {HUNDREDTHS!r} THEN CAST({_AMOUNT} // 100 AS VARCHAR) || '.'
            || lpad(CAST({_AMOUNT} % 100 AS VARCHAR), 2, '0')
          ELSE CAST({_AMOUNT} AS VARCHAR) END AS value,
        l_suppkey AS set_no
      FROM lineitem CROSS JOIN par
      WHERE CASE WHEN n < 12 THEN (l_partkey + 3 * n) % 5 <> 0 WHEN n < 16 THEN (l_partkey + 3 * n) % 5 = 1
        ELSE (l_partkey + 3 * n) % 20 = 1 END
    )""",
    "lines": """lines AS (
      SELECT DISTINCT l_orderkey * 10 + l_linenumber AS line_id, l_orderkey AS sample_id,
        c_nationkey AS order_id, items.item AS item,
        CASE WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Completed' END AS status
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN items ON items.pos = l_linenumber
    )""",
    "smp": """smp AS (
      SELECT o_orderkey AS sample_id, o_custkey AS producer_id,
        lpad(CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 101 = 0 THEN 10 ELSE 14 END, '0')
          AS bar_code,
        CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority END AS tank,
        CASE WHEN o_orderkey % 89 <> 0
          THEN make_timestamp(year(o_orderdate), 1, 1, 3, 0, 0) END AS sampling_time,
        CASE WHEN o_orderkey % 53 <> 0
          THEN CAST(CAST(trunc(o_totalprice) AS BIGINT) % 45 AS DOUBLE) END AS sample_temp,
        CAST(CAST(trunc(o_totalprice) AS BIGINT) % 40 AS DOUBLE) AS parcel_temp,
        CASE WHEN o_orderkey % 22 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN 'N/A'
          WHEN o_orderkey % 13 <> 0 THEN 'W' || (o_orderkey % 52) END AS billing_week,
        'CHR' || (o_orderkey % 1000) AS chr_number, 'CKR' || (o_custkey % 1000) AS ckr_number
      FROM orders
    )""",
    "prod": """prod AS (
      SELECT c_custkey AS producer_id, c_name AS producer_code, 'Farm ' || c_custkey AS producer_name,
        CASE WHEN c_custkey % 41 <> 0 THEN a.label END AS region, b.label AS state,
        'REP ' || n_name AS state_rep, c_mktsegment AS field_rep, 'P' || c_custkey AS permit_number,
        'B' || c_nationkey AS btu_number,
        CASE c_custkey % 3 WHEN 0 THEN '' WHEN 2 THEN 'A' END AS grade,
        'R' || c_nationkey AS route_number, 'V' || (c_custkey % 10) AS visit_number
      FROM customer JOIN nation ON n_nationkey = c_nationkey
      JOIN states a ON a.pos = n_regionkey JOIN states b ON b.pos = (c_nationkey + 1) % 5
    )""",
    "grp": """grp AS (
      SELECT c_custkey AS producer_id, 'EVERY THIRD' AS group_name FROM customer WHERE c_custkey % 3 = 0
      UNION ALL
      SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 10 <> 9
    )""",
    "ctx": """ctx AS (
      SELECT lines.*, smp.* EXCLUDE (sample_id), prod.* EXCLUDE (producer_id),
        right(bar_code, 4) AS seq, substr(bar_code, 11, 4) AS mid_seq,
        CAST(sampling_time - INTERVAL 5 HOUR AS DATE) AS sampling_date,
        n_name AS client_name, 'CO-' || order_id AS order_code
      FROM lines JOIN smp USING (sample_id) JOIN prod USING (producer_id)
      JOIN nation ON n_nationkey = order_id
      WHERE status = 'Completed'
    )""",
    # Lines last validated in the closed window used for the official report.
    "closed": """closed AS (
      SELECT line_id FROM rr JOIN lines USING (line_id) WHERE status = 'Completed' GROUP BY line_id
      HAVING max(validated) >= TIMESTAMP '1997-01-01 05:00:00'
        AND max(validated) <= TIMESTAMP '1999-01-01 05:00:00'
    )""",
    # 1500 days back from local midnight, and 1500 days back from the minute.
    "recent": """recent AS (
      SELECT line_id FROM rr GROUP BY line_id
      HAVING max(validated) > TIMESTAMP '1996-05-23 05:00:00'
        AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'
    )""",
    "exact": """exact AS (
      SELECT line_id FROM rr GROUP BY line_id
      HAVING max(validated) > TIMESTAMP '1996-05-23 17:00:00'
        AND max(validated) <= TIMESTAMP '2000-07-01 17:00:00'
    )""",
    "known": "known AS (SELECT item FROM items WHERE pos < 7)",
}

CODED = """CASE WHEN lower(rtrim(value)) = 'not found' THEN 'NF'
  WHEN lower(rtrim(value)) = 'positive' THEN 'AL' ELSE value END"""
DAY = "strftime({0}, '%Y-%m-%d') AS {1}"


def number(value: str) -> str:
    return f"CASE WHEN trim({value}) = '' THEN 0 ELSE TRY_CAST({value} AS DOUBLE) END"


def mean(value: str) -> str:
    return f"CAST(CAST(round(avg({number(value)})) AS BIGINT) AS VARCHAR)"


def measures(labels, value: str = "value") -> str:
    return ", ".join(f"max(CASE WHEN name = '{m}' THEN {value} END) AS \"{m}\"" for m in labels)


def official(codes) -> str:
    return f"CASE WHEN test_code IN {_list(codes)} THEN 'Y' ELSE 'N' END"


def lab(body: str, *extra: str) -> str:
    """``body`` preceded by the extra CTEs and those laboratory tables that they use."""
    used, look = set(), [body, *extra]
    while look:
        words = set(re.findall(r"\w+", look.pop()))
        for name in CTES.keys() & words - used:
            used.add(name)
            look.append(CTES[name])
    parts = [*(sql for name, sql in CTES.items() if name in used), *extra]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
