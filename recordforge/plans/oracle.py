"""DuckDB SQL oracles for the registered queries.

Independent re-statements of each operator in plain SQL over the driver's
views (``customer``, ``pages``, ``part``). They are used only to check the
Spark results; nothing here runs on Spark.
"""

from __future__ import annotations

from .. import config
from ..functions.text import PY_WHITESPACE, regex_literal
from ..operators.score import SIGNALS
from ..sources.csv import load_nulls
from ..sources.fixture import venues_sql_duckdb
from .catalog import ALT_WEIGHTS, PART_THRESHOLD, QUANTILE_COLUMNS, QUANTILE_PROBS

CASED = r"\p{Lu}\p{Ll}\p{Lt}"
COLS = config.REQUIRED_COLUMNS
STRING_COLS = [c for c in COLS if c not in ("latitude", "longitude")]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({q(repr(float(x)))} AS DOUBLE)"


def strip(x: str) -> str:
    return f"trim({x}, {q(PY_WHITESPACE)})"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {q('[' + PY_WHITESPACE + ']+')}, ' ', 'g')"


def title(x: str) -> str:
    pat = q(f"([{CASED}]+|[^{CASED}]+)")
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, {pat}), lambda r: "
        f"CASE WHEN regexp_matches(r, {q('^[' + CASED + ']')}) THEN upper(r[1]) || lower(r[2:]) ELSE r END), '')"
    )


def name_case(x: str) -> str:
    s = strip(x)
    return (
        f"CASE WHEN {s} IS NULL THEN NULL "
        f"WHEN upper({s}) = {s} AND length(replace({s}, ' ', '')) <= 5 THEN {s} "
        f"WHEN upper({s}) = {s} OR lower({s}) = {s} THEN {title(s)} ELSE {s} END"
    )


def nulls(x: str, values) -> str:
    return f"CASE WHEN {x} IN ({', '.join(q(v) for v in values)}) THEN NULL ELSE {x} END"


def url(x: str) -> str:
    u = f"rtrim({strip(x)}, '/')"
    return f"CASE WHEN length({u}) >= {config.MIN_URL_LENGTH} THEN {u} END"


def match(x: str) -> str:
    return f"coalesce({collapse(strip(f'lower({x})'))}, '')"


def sorttok(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def smap(x: str, mapping: dict, as_double=False) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {dbl(v) if as_double else q(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} END"


def any_contains(x: str, tokens) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(t)})" for t in tokens) + ")"


def first_kw(x: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN contains({x}, {q(k)}) THEN {q(v)}" for k, v in rules) + " END"


def price_chain(pp, pt, web) -> str:
    flat = f"regexp_replace(lower({web}), '[^a-z0-9]', '', 'g')"
    by_url = f"CASE WHEN {web} IS NOT NULL AND {any_contains(flat, config.URL_HIGH_TOKENS)} THEN 'high' END"
    return f"coalesce({pp}, {smap(strip(pt), config.TYPE_PRICE_MAP)}, {by_url})"


def city_extract(city, addr) -> str:
    names = sorted(config.KNOWN_CITIES, key=len, reverse=True)
    pat = "(?i)(" + "|".join(regex_literal(n) for n in names) + ")"
    return f"coalesce({city}, nullif(regexp_extract({addr}, {q(pat)}, 1), ''))"


def lower_or_blank(x: str) -> str:
    return f"coalesce(lower({x}), '')"


def waterfall(pt, name, web) -> str:
    lookup = smap(f"lower({pt})", config.PRIMARY_TYPE_TO_CUISINE)
    fb = q(config.FALLBACK_CUISINE)
    return (
        f"coalesce(nullif({lookup}, {fb}), "
        f"{first_kw(lower_or_blank(name), config.NAME_KEYWORDS_TO_CUISINE)}, "
        f"{first_kw(lower_or_blank(web), config.WEBSITE_KEYWORDS_TO_CUISINE)}, {fb})"
    )


def name_city(name: str = "name", city: str = "city") -> str:
    return f"coalesce({name}, '') || ' ' || coalesce({city}, '')"


def completeness(cols=COLS) -> str:
    return " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in cols)


def round_np(x: str, d: int) -> str:
    s = dbl(10.0**d)
    return f"round_even(({x}) * {s}, 0) / {s}"


def signals() -> dict[str, str]:
    price_num = smap("price_point", config.PRICE_POINT_NUMERIC, as_double=True)
    default = (config.PRICE_POINT_DEFAULT - 1.0) / 3.0
    lname = "coalesce(lower(name), '')"
    return {
        "price_point": f"least(greatest(coalesce(({price_num} - {dbl(1.0)}) / {dbl(3.0)}, {dbl(default)}), {dbl(0.0)}), {dbl(1.0)})",
        "address": f"CASE WHEN {any_contains('lower(display_address)', config.HIGH_TICKET_ADDRESS_TOKENS)} THEN {dbl(1.0)} ELSE {dbl(0.0)} END",
        "fancy_type": f"CASE WHEN lower(primary_type) IN ({', '.join(q(t) for t in config.FANCY_PRIMARY_TYPES)}) THEN {dbl(1.0)} ELSE {dbl(0.0)} END",
        "name_keyword": (
            f"CASE WHEN {any_contains(lname, config.ROMANTIC_NAME_KEYWORDS_HIGH)} THEN {dbl(1.0)} "
            f"WHEN {any_contains(lname, config.ROMANTIC_NAME_KEYWORDS_MEDIUM)} THEN {dbl(0.5)} ELSE {dbl(0.0)} END"
        ),
        "cuisine": f"coalesce({smap('cuisine_category', config.CUISINE_ROMANCE_SCORE, as_double=True)}, {dbl(config.DEFAULT_CUISINE_AFFINITY)})",
        "has_website": f"CASE WHEN length({strip('website')}) > 0 THEN {dbl(1.0)} ELSE {dbl(0.0)} END",
    }


def label(x: str) -> str:
    parts = [f"WHEN {x} IS NULL THEN 'nan'"]
    for edge, lab in zip(config.SCORE_BIN_EDGES, config.SCORE_LABELS):
        parts.append(f"WHEN {x} <= {dbl(edge)} THEN {q(lab)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(config.SCORE_LABELS[-1])} END"


def enrich_select(src: str, weights=None) -> str:
    weights = config.ROMANTIC_SCORE_WEIGHTS if weights is None else weights
    sig = signals()
    raw = " + ".join(f"{dbl(weights[k])} * sig_{k}" for k, _ in SIGNALS)
    score = round_np(f"({raw}) * {dbl(10.0)}", 1)
    inner = (
        f"SELECT *, {', '.join(f'{sig[k]} AS sig_{k}' for k, _ in SIGNALS)} FROM "
        f"(SELECT *, {waterfall('primary_type', 'name', 'website')} AS cuisine_category FROM {src})"
    )
    cols = ", ".join(COLS)
    scores = ", ".join(f"{round_np(f'sig_{k}', 3)} AS {n}" for k, n in SIGNALS)
    return (
        f"SELECT {cols}, cuisine_category, {scores}, score AS romantic_score, {label('score')} AS romantic_label "
        f"FROM (SELECT *, {score} AS score FROM ({inner}))"
    )


# --------------------------------------------------------------------------
# merge rules (M1-M7) as ordered, filtered aggregates
# --------------------------------------------------------------------------

_ORD = "comp DESC, id ASC"


def _pres(c: str) -> str:
    return f"({c} IS NOT NULL AND {strip(c)} <> '')"


def _first(c: str) -> str:
    return f"coalesce(first({c} ORDER BY {_ORD}) FILTER (WHERE {_pres(c)}), first({c} ORDER BY {_ORD}))"


def merge_expr(c: str) -> str:
    base = f"first({c} ORDER BY {_ORD})"
    if c == "display_address":
        return f"coalesce(first({c} ORDER BY length({c}) DESC, {_ORD}) FILTER (WHERE {_pres(c)}), {base})"
    if c == "website":
        return f"coalesce(first({c} ORDER BY length({c}) ASC, {_ORD}) FILTER (WHERE {_pres(c)}), {base})"
    if c == "primary_type":
        spec = f"{_pres(c)} AND lower({strip(c)}) <> {q(config.GENERIC_TYPE)}"
        return (
            f"coalesce(first({c} ORDER BY {_ORD}) FILTER (WHERE {spec}), "
            f"last({c} ORDER BY {_ORD}) FILTER (WHERE {_pres(c)}), {base})"
        )
    if c == "name":
        mixed = f"{_pres(c)} AND {c} <> upper({c}) AND {c} <> lower({c})"
        return f"coalesce(first({c} ORDER BY {_ORD}) FILTER (WHERE {mixed}), {_first(c)})"
    if c in ("latitude", "longitude"):
        return (
            f"list_reduce(list({c} ORDER BY {_ORD}) FILTER (WHERE {c} IS NOT NULL AND NOT isnan({c})), "
            f"lambda a, x: (a + x) / {dbl(2.0)})"
        )
    return _first(c)


def merge_select(src: str, key: str) -> str:
    """SELECT merging the rows of ``src`` (with a ``comp`` column) by ``key``."""
    exprs = [key if c == key else f"{merge_expr(c)} AS {c}" for c in COLS]
    return f"SELECT {', '.join(exprs)} FROM {src} GROUP BY {key}"


# --------------------------------------------------------------------------
# similarity: bit-parallel LCS over HUGEINT masks (strings up to 126 chars)
# --------------------------------------------------------------------------


def lcs(a: str, b: str) -> str:
    mask = f"((1::HUGEINT << length({a})) - 1)"
    pm = (
        f"list_sum(list_transform(range(length({a})), lambda p: "
        f"CASE WHEN {a}[p + 1] = ch THEN (1::HUGEINT << p) ELSE 0::HUGEINT END))"
    )
    fold = (
        f"list_reduce(list_transform(string_split({b}, ''), lambda ch: {pm}), "
        f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & {mask}, {mask})"
    )
    return f"(length({a}) - bit_count({fold}))"


def pairs_select(reps: str, t: int) -> str:
    la, lb = "length(a.key)", "length(b.key)"
    return (
        f"SELECT a.cohort, a.key AS key_a, b.key AS key_b, a.rep AS rep_a, b.rep AS rep_b "
        f"FROM {reps} a JOIN {reps} b ON a.cohort = b.cohort AND a.key < b.key "
        f"WHERE 200 * least({la}, {lb}) >= {t} * ({la} + {lb}) "
        f"AND 200 * {lcs('a.key', 'b.key')} >= {t} * ({la} + {lb})"
    )


# --------------------------------------------------------------------------
# CTE chains
# --------------------------------------------------------------------------


def base_ctes() -> list[str]:
    load = ", ".join(f"{nulls(c, load_nulls())} AS {c}" if c in STRING_COLS else c for c in COLS)
    o1 = ", ".join(f"{nulls(c, config.NULL_STRINGS)} AS {c}" if c in STRING_COLS else c for c in COLS)
    o2 = []
    for c in COLS:
        if c == "name":
            o2.append(f"{name_case(strip(c))} AS name")
        elif c in ("city", "display_address"):
            o2.append(f"{strip(c)} AS {c}")
        elif c == "website":
            o2.append(f"{url(strip(c))} AS website")
        elif c in ("price_point", "primary_type"):
            o2.append(f"{strip(f'lower({c})')} AS {c}")
        else:
            o2.append(c)
    i1 = ", ".join(
        f"{price_chain('price_point', 'primary_type', 'website')} AS price_point" if c == "price_point" else c
        for c in COLS
    )
    i2 = ", ".join(f"{city_extract('city', 'display_address')} AS city" if c == "city" else c for c in COLS)
    return [
        f"venues_raw AS ({venues_sql_duckdb()})",
        f"loaded AS (SELECT {load} FROM venues_raw)",
        f"norm1 AS (SELECT {o1} FROM loaded)",
        f"norm2 AS (SELECT {', '.join(o2)} FROM norm1)",
        f"norm3 AS (SELECT {i1} FROM norm2)",
        f"prepared AS (SELECT {i2} FROM norm3)",
    ]


def fuzzy_ctes(src: str = "prepared") -> list[str]:
    unk = q(config.UNKNOWN_COHORT)
    return [
        f"pool AS (SELECT * FROM {src} WHERE google_place_id IS NULL)",
        "pool_keys AS (SELECT id, "
        f"coalesce(city, {unk}) AS cohort, "
        f"{sorttok(match('display_address'))} AS addr_key, "
        f"{sorttok(match(name_city()))} AS nc_key "
        "FROM pool)",
        "addr_reps AS (SELECT cohort, addr_key AS key, min(id) AS rep FROM pool_keys WHERE addr_key <> '' GROUP BY cohort, addr_key)",
        "nc_reps AS (SELECT cohort, nc_key AS key, min(id) AS rep FROM pool_keys WHERE nc_key <> '' GROUP BY cohort, nc_key)",
        f"addr_pairs AS ({pairs_select('addr_reps', config.FUZZY_ADDRESS_THRESHOLD)})",
        f"nc_pairs AS ({pairs_select('nc_reps', config.FUZZY_NAME_CITY_THRESHOLD)})",
        "edges AS ("
        "SELECT k.id AS src, r.rep AS dst FROM pool_keys k JOIN addr_reps r ON k.cohort = r.cohort AND k.addr_key = r.key "
        "UNION ALL SELECT k.id, r.rep FROM pool_keys k JOIN nc_reps r ON k.cohort = r.cohort AND k.nc_key = r.key "
        "UNION ALL SELECT rep_a, rep_b FROM addr_pairs UNION ALL SELECT rep_a, rep_b FROM nc_pairs)",
        "edges2 AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges)",
        "reach(node, root) AS (SELECT id, id FROM pool UNION SELECT e.b, r.root FROM reach r JOIN edges2 e ON r.node = e.a)",
        "clusters AS MATERIALIZED (SELECT node AS id, min(root) AS cluster_id FROM reach GROUP BY node)",
        f"pool_comp AS (SELECT p.*, c.cluster_id, {completeness()} AS comp FROM pool p JOIN clusters c USING (id))",
        f"fuzzy_merged AS ({merge_select('pool_comp', 'cluster_id')})",
    ]


def clean_ctes() -> list[str]:
    # MATERIALIZED: evaluate the recursive components once, not per reference
    return base_ctes() + [
        f"keyed AS (SELECT *, {completeness()} AS comp FROM prepared WHERE google_place_id IS NOT NULL)",
        f"exact_merged AS ({merge_select('keyed', 'google_place_id')})",
    ] + fuzzy_ctes() + [
        f"clean AS MATERIALIZED (SELECT {', '.join(COLS)} FROM exact_merged UNION ALL SELECT {', '.join(COLS)} FROM fuzzy_merged)",
        f"enriched AS MATERIALIZED ({enrich_select('clean')})",
    ]


def with_(ctes: list[str], body: str) -> str:
    rec = "RECURSIVE " if any(c.startswith("reach(") for c in ctes) else ""
    return f"WITH {rec}" + ",\n".join(ctes) + "\n" + body


def null_counts_sql(src: str) -> str:
    parts = [
        f"SELECT {q(c)} AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM {src}"
        for c in COLS
    ]
    return " UNION ALL ".join(parts)


def build() -> dict[str, str]:
    sel = ", ".join(COLS)
    b = base_ctes()
    sq: dict[str, str] = {}
    sq["csv_roundtrip"] = with_(b, f"SELECT {sel} FROM loaded")
    sq["null_profile"] = with_(b, f"SELECT * FROM ({null_counts_sql('loaded')}) WHERE nulls > 0")
    raw_o1 = ", ".join(f"{nulls(c, config.NULL_STRINGS)} AS {c}" if c in STRING_COLS else c for c in COLS)
    sq["norm_nulls"] = with_(b, f"SELECT {raw_o1} FROM venues_raw")
    sq["norm_strip"] = with_(b, "SELECT id, " + ", ".join(f"{strip(c)} AS {c}" for c in config.TEXT_COLUMNS) + " FROM venues_raw")
    n1 = f"(SELECT {raw_o1} FROM venues_raw)"
    sq["norm_case"] = with_(b, f"SELECT id, {name_case(strip('name'))} AS name FROM {n1}")
    sq["norm_lower"] = with_(
        b, f"SELECT id, {strip('lower(price_point)')} AS price_point, {strip('lower(primary_type)')} AS primary_type FROM {n1}"
    )
    sq["norm_url"] = with_(b, f"SELECT id, {url('website')} AS website FROM {n1}")
    sq["norm_url_pages"] = f"SELECT page_id, {url('url')} AS url FROM pages"
    nc = name_city()
    sq["match_key"] = with_(
        b, f"SELECT id, {match('display_address')} AS addr_key, {match(nc)} AS nc_key FROM prepared"
    )
    sq["completeness"] = with_(b, f"SELECT id, {completeness()} AS completeness FROM loaded")
    sq["impute_chain"] = with_(b, f"SELECT id, {price_chain('price_point', 'primary_type', 'website')} AS price_point FROM norm2")
    sq["impute_extract"] = with_(b, f"SELECT id, {city_extract('city', 'display_address')} AS city FROM norm2")
    keyed = b + [f"keyed AS (SELECT *, {completeness()} AS comp FROM prepared WHERE google_place_id IS NOT NULL)"]
    sq["merge_rules"] = with_(
        keyed,
        f"SELECT {', '.join(c for c in COLS if c not in ('latitude', 'longitude'))} FROM ({merge_select('keyed', 'google_place_id')})",
    )
    sq["merge_coords"] = with_(keyed, f"SELECT google_place_id, latitude, longitude FROM ({merge_select('keyed', 'google_place_id')})")
    sq["dedup_exact"] = with_(
        keyed,
        f"SELECT {sel} FROM ({merge_select('keyed', 'google_place_id')}) "
        f"UNION ALL SELECT {sel} FROM prepared WHERE google_place_id IS NULL",
    )
    fz = b + fuzzy_ctes()
    sq["fuzzy_pairs"] = with_(fz, "SELECT cohort, key_a, key_b FROM addr_pairs")
    sq["fuzzy_pairs_name"] = with_(fz, "SELECT cohort, key_a, key_b FROM nc_pairs")
    part = (
        f"part_reps AS (SELECT p_brand AS cohort, {sorttok(match('p_name'))} AS key, min(p_partkey) AS rep FROM part "
        f"WHERE {sorttok(match('p_name'))} <> '' GROUP BY ALL)"
    )
    sq["fuzzy_pairs_part"] = with_(
        [part], f"SELECT cohort, key_a, key_b, rep_a AS node_a, rep_b AS node_b FROM ({pairs_select('part_reps', PART_THRESHOLD)})"
    )
    sq["merge_segment"] = (
        "SELECT c_mktsegment, min(c_custkey) AS c_custkey, first(c_name ORDER BY length(c_name) DESC, c_custkey) AS c_name, "
        f"round(list_reduce(list(CAST(c_acctbal AS DOUBLE) ORDER BY c_custkey), lambda a, x: (a + x) / {dbl(2.0)}), 6) AS c_acctbal "
        "FROM customer GROUP BY c_mktsegment"
    )
    sq["csv_job"] = with_(clean_ctes(), "SELECT * FROM enriched")
    sq["fuzzy_clusters"] = with_(fz, "SELECT id, cluster_id FROM clusters")
    sq["dedup_fuzzy"] = with_(fz, f"SELECT {sel} FROM fuzzy_merged")
    cl = clean_ctes()
    sq["clean_pipeline"] = with_(cl, f"SELECT {sel} FROM clean")
    sq["incremental_clean"] = sq["clean_pipeline"]
    last = "max(CASE WHEN CAST(id AS BIGINT) % 3 = 2 THEN 1 ELSE 0 END) = 1"
    sq["incremental_touched"] = with_(
        cl,
        f"SELECT (SELECT count(*) FROM loaded WHERE CAST(id AS BIGINT) % 3 = 2) AS rows_added, count(*) AS groups_merged, "
        f"CAST(sum(n) AS BIGINT) AS rows_merged FROM ("
        f"SELECT count(*) AS n FROM keyed GROUP BY google_place_id HAVING {last} "
        f"UNION ALL SELECT count(*) FROM clusters GROUP BY cluster_id HAVING {last})",
    )
    sq["classify_lookup"] = with_(
        b, f"SELECT id, primary_type, {smap('lower(primary_type)', config.PRIMARY_TYPE_TO_CUISINE)} AS cuisine FROM prepared"
    )
    sq["classify_keywords"] = with_(
        b, f"SELECT id, name, {first_kw(lower_or_blank('name'), config.NAME_KEYWORDS_TO_CUISINE)} AS cuisine FROM prepared"
    )
    sq["classify_keywords_part"] = (
        f"SELECT p_partkey, p_name, {first_kw(lower_or_blank('p_name'), config.NAME_KEYWORDS_TO_CUISINE)} AS cuisine FROM part"
    )
    sq["classify_waterfall"] = with_(
        b, f"SELECT id, {waterfall('primary_type', 'name', 'website')} AS cuisine_category FROM prepared"
    )
    pe = b + [f"penr AS ({enrich_select('prepared')})", f"penr_alt AS ({enrich_select('prepared', ALT_WEIGHTS)})"]
    sq["score_signals"] = with_(pe, "SELECT id, " + ", ".join(n for _, n in SIGNALS) + " FROM penr")
    sq["score_weighted"] = with_(pe, "SELECT id, romantic_score FROM penr")
    sq["score_weighted_alt"] = with_(pe, "SELECT id, romantic_score FROM penr_alt")
    sq["score_label"] = with_(pe, "SELECT id, romantic_score, romantic_label FROM penr")
    ncols = len(COLS) + len(config.ENRICHED_COLUMNS)
    sq["enrich_pipeline"] = with_(cl, "SELECT * FROM enriched")
    sq["report_metrics"] = with_(
        cl,
        "SELECT (SELECT count(*) FROM loaded) AS rows_in, (SELECT count(*) FROM clean) AS rows_clean, "
        "(SELECT count(*) FROM enriched) AS rows_enriched, "
        "(SELECT count(*) FROM loaded) - (SELECT count(*) FROM clean) AS duplicates_removed, "
        f"CAST({ncols} AS BIGINT) AS columns",
    )
    sq["report_null_filled"] = with_(
        cl,
        f"SELECT r.\"column\", r.nulls - c.nulls AS filled FROM ({null_counts_sql('loaded')}) r "
        f"JOIN ({null_counts_sql('clean')}) c USING (\"column\") WHERE r.nulls > c.nulls",
    )
    sq["report_null_left"] = with_(cl, f"SELECT * FROM ({null_counts_sql('clean')}) WHERE nulls > 0")
    sq["report_summary"] = with_(
        cl,
        "SELECT round(avg(romantic_score), 6) AS mean, round(median(romantic_score), 6) AS median, "
        "round(stddev_samp(romantic_score), 6) AS std, min(romantic_score) AS min, max(romantic_score) AS max FROM enriched",
    )
    sq["report_labels"] = with_(
        cl,
        f"SELECT romantic_label, count(*) AS count, round({dbl(100.0)} * count(*) / (SELECT count(*) FROM enriched), 6) AS pct "
        "FROM enriched GROUP BY romantic_label",
    )
    sq["report_categories"] = with_(
        cl,
        "SELECT cuisine_category, count(*) AS count FROM enriched GROUP BY cuisine_category "
        "ORDER BY count DESC, cuisine_category ASC NULLS FIRST LIMIT 10",
    )
    for key, k, asc in (("report_top", 10, False), ("report_bottom", 5, True)):
        o = "ASC" if asc else "DESC"
        sq[key] = with_(
            cl,
            "SELECT name, city, cuisine_category, romantic_score FROM ("
            "SELECT *, row_number() OVER (PARTITION BY name ORDER BY romantic_score "
            f"{o}, id ASC) AS rn FROM enriched) WHERE rn = 1 "
            f"ORDER BY romantic_score {o}, name ASC NULLS FIRST LIMIT {k}",
        )
    sq["csv_split"] = (
        f"SELECT doc_id, {', '.join(nulls(c, load_nulls()) + ' AS ' + c for c in ('lang', 'source'))}, "
        "length(t) AS n_chars, md5(t) AS text_md5 "
        f"FROM (SELECT *, {nulls('text', load_nulls())} AS t FROM documents)"
    )
    sq["report_quantiles"] = " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", {dbl(p)} AS prob, count({c}) AS n, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in QUANTILE_COLUMNS
        for p in QUANTILE_PROBS
    )
    words = "SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM documents"
    sq["report_words"] = (
        f"SELECT word, count(*) AS count FROM ({words}) WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 20"
    )
    sq["report_items"] = (
        "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey ORDER BY count DESC, l_partkey NULLS FIRST LIMIT 10"
    )
    sq["classify_rules_documents"] = (
        f"WITH rules AS (SELECT substr(lower(word), 1, 3) AS keyword, count(*) AS priority FROM ({words}) "
        "WHERE regexp_matches(substr(lower(word), 1, 3), '^[a-z]{3}$') GROUP BY keyword), "
        "hits AS (SELECT doc_id, arg_min(keyword || '/' || priority, (priority, keyword)) AS rule FROM documents, rules "
        "WHERE contains(lower(text), keyword) GROUP BY doc_id) "
        "SELECT doc_id, rule FROM documents LEFT JOIN hits USING (doc_id)"
    )
    return sq
