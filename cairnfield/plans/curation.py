"""Queries by the curation, geography and matching operators, and their SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.functions import text
from cairnfield.functions.keys import key_form
from cairnfield.operators import address as A
from cairnfield.operators import curate, geo, match, stats_dict
from cairnfield.sources.tables import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


RULES = A.Rules()
SUFFIXES = sorted(set(RULES.suffixes.values()))

#: What counts as a street suffix in the SQL, stated apart from the engine's own list.
SQL_SUFFIXES = (
    "Alley Anex Arcade Avenue Bayou Beach Bend Bluff Bluffs Bottom Boulevard Branch Bridge Brook Brooks Burg Burgs Bypass Camp Canyon Cape Causeway Center Centers Circle Circles Cliff Cliffs Club Common Commons Corner Corners Course Court "
    "Courts Cove Coves Creek Crescent Crest Crossing Crossroad Crossroads Curve Dale Dam Divide Drive Drives Estate Estates Expressway Extension Extensions Fall Falls Ferry Field Fields Flat Flats Fm Ford Fords Forest Forge Forges Fork Forks "
    "Fort Freeway Garden Gardens Gateway Glen Glens Green Greens Grove Groves Harbor Harbors Haven Heights Highway Hill Hills Hollow Inlet Island Islands Isle Junction Junctions Key Keys Knoll Knolls Lake Lakes Land Landing Lane Light Lights "
    "Loaf Lock Locks Lodge Loop Mall Manor Manors Meadow Meadows Mews Mill Mills Mission Motorway Mount Mountain Mountains Neck Orchard Oval Overpass Park Parks Parkway Parkways Pass Passage Path Pike Pine Pines Place Plain Plains Plaza Point "
    "Points Port Ports Prairie Radial Ramp Ranch Rapid Rapids Rest Ridge Ridges River Road Roads Route Row Rue Run Shoal Shoals Shore Shores Skyway Spring Springs Spur Spurs Square Squares Station Stravenue Stream Street Streets Summit Terrace "
    "Throughway Trace Track Trafficway Trail Trailer Tunnel Turnpike Underpass Union Unions Valley Valleys Viaduct View Views Village Villages Ville Vista Walk Walks Wall Way Ways Well Wells"
).split() + ["County Road", "State Road"]
SQL_SPANISH = "Avenida Calle Caminito Camino Cerrada Circulo Corte Entrada Paseo Placita Rancho Vereda Vista Norte".split()
SQL_DIRECTIONS = ["North", "South", "East", "West", "North East", "North West", "South East", "South West"]
_EVERY, _ROADS, _DIRS = _list(SQL_SUFFIXES + SQL_SPANISH), _list(SQL_SUFFIXES), _list(SQL_DIRECTIONS)


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sorted(table.items())) + "}"


# row rules in SQL: words of a text, their form, and the three parts that are inferred of a record
_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(replace(replace({0}, 'c/o', ' '), 'C/O', ' '), '[.;,#@:/"()-]', ' ', 'g'), '(\d+)', ' \1 ', 'g'), '''s\b', ' ''s', 'g')"""
_TOKENS = r"regexp_extract_all(" + _CLEAN + r", '''s\b|[&!?$%\[\]{{}}<>]|[^\s&!?$%\[\]{{}}<>'']+(?:''[^\s&!?$%\[\]{{}}<>'']*)*|''')"
_GRID_AT = r"(?i)^(?:[nsew]\s?)?(?:\d+\s?)?[nsew]\s?\d+"


def _written(tokens: str) -> str:
    word = f"CASE WHEN regexp_matches(w, '{_GRID_AT}') THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END"
    return rf"trim(regexp_replace(array_to_string(list_transform(string_split(array_to_string({tokens}, ' '), ' '), lambda w: {word}), ' '), ' (''s\b|[!?%])', '\1', 'g'))"


def _stated(tokens: str, known: str) -> str:
    """What another field states of a sub-location that isn't known yet."""
    names = _list(A.SUBLOCATIONS.values())
    ok = lambda at: f"list_contains({names}, {at}) AND NOT list_contains({known}, {at})"
    return (
        f"CASE WHEN len({tokens}) = 2 AND {ok(tokens + '[2]')} AND length({tokens}[1]) < 3 THEN [{tokens}[2], {tokens}[1]] ELSE flatten(list_transform(list_filter(range(1, len({tokens})), lambda i: {ok(tokens + '[i]')} "
        f"AND (length({tokens}[i + 1]) < 3 OR regexp_matches({tokens}[i + 1], '^\\d+$'))), lambda i: CASE WHEN regexp_matches(coalesce({tokens}[i + 2], ''), '^\\d+$') THEN [{tokens}[i], {tokens}[i + 1], {tokens}[i + 2]] ELSE [{tokens}[i], {tokens}[i + 1]] END)) END"
    )


def _inferred_sql(source: str, others: tuple[str, ...]) -> str:
    """CTEs that end in `inferred`: the columns of `source` (with number and street) beside address, lvl1 and lvl2."""
    sub, addr, plain = _map(A.SUBLOCATIONS), _map(RULES.suffixes | A.DIRECTIONS), _map(A.SPANISH | A.DIRECTIONS)
    known = lambda t: f"map_contains({sub}, lower({t}))"
    swapped = lambda tokens, table: f"list_transform({tokens}, lambda t: coalesce({table}[lower(t)], t))"
    steps = [
        f"i0 AS (SELECT *, list_filter({_TOKENS.format('coalesce(street, ' + chr(39) * 2 + ')')}, lambda t: NOT list_contains({_list(A.IGNORED)}, lower(t))) AS t0 FROM ({source}))",
        f"i1 AS (SELECT *, list_filter(range(1, len(t0) + 1), lambda i: {known('t0[i]')}) AS named FROM i0)",
        f"i2 AS (SELECT *, coalesce(list_filter(named, lambda i: i < len(t0) AND NOT map_contains({_map(RULES.suffixes)}, lower(t0[i + 1])))[1], len(t0) + 1) AS b FROM i1)",
        "i3 AS (SELECT *, CASE WHEN named[1] = 1 THEN t0[named[-1] + 2:] ELSE t0[:b - 1] END AS s0, CASE WHEN named[1] = 1 THEN t0[:named[-1] + 1] ELSE t0[b:] END AS below0 FROM i2)",
        "i4 AS (SELECT *, CASE WHEN number <> '' AND NOT list_contains(s0, number) THEN list_prepend(number, s0) ELSE s0 END AS s1 FROM i3)",
        f"i5 AS (SELECT *, {_written('s1')} AS w FROM i4)",
        rf"i6 AS (SELECT *, CASE WHEN list_has_any(s1, ['th', 'nd', 'st', 'rd']) THEN s1 ELSE list_filter(string_split(CASE WHEN regexp_matches(w, '{_GRID_AT}') THEN replace(regexp_extract(w, '{_GRID_AT}'), ' ', '') || ' ' || regexp_replace(w, '{_GRID_AT}\s?', '') ELSE w END, ' '), lambda x: x <> '') END AS s2 FROM i5)",
        f"i7 AS (SELECT *, {swapped('s2', addr)} AS s3 FROM i6)",
        f"i8 AS (SELECT *, CASE WHEN list_has_any(s3, {_ROADS}) THEN s3 ELSE {swapped('s3', plain)} END AS s4, {swapped('below0', sub)} AS b0 FROM i7)",
    ]
    for k, c in enumerate(others):
        steps.append(f"o{k} AS (SELECT *, {swapped(_TOKENS.format(f'coalesce({c}, {chr(39) * 2})'), sub)} AS ot{k} FROM {'i8' if k == 0 else f'p{k - 1}'})")
        steps.append(f"p{k} AS (SELECT *, list_concat(b{k}, {_stated(f'ot{k}', f'b{k}')}) AS b{k + 1} FROM o{k})")
    last = f"b{len(others)}"
    cut = f"coalesce(list_filter(range(1, len({last}) + 1), lambda i: list_contains({_list(A.SECOND_LEVEL)}, {last}[i]))[1], len({last}) + 1)"
    steps.append(f"i9 AS (SELECT *, {cut} AS c FROM {f'p{len(others) - 1}' if others else 'i8'})")
    steps.append(f"inferred AS (SELECT * EXCLUDE (c), {_written('s4')} AS address, {_written(f'{last}[:c - 1]')} AS lvl1, {_written(f'{last}[c:]')} AS lvl2 FROM i9)")
    return ", ".join(steps)


# the population of addresses: canonical streets and, as typed, those of the raw records
_POOL = r"""pool AS (SELECT nullif(trim(regexp_replace(a, '\s+', ' ', 'g')), '') AS a FROM (SELECT OPS_STREET AS a FROM ops_location UNION ALL SELECT OPS_STREET FROM soldto_location UNION ALL SELECT STREET FROM dim_location_soldto)),
f AS (SELECT '' AS scope, a AS address, count(*) AS n, list_filter(string_split_regex(a, '\s+'), lambda x: x <> '') AS tokens, array_to_string(list_filter(string_split_regex(a, '\s+'), lambda x: x <> ''), ' ') AS txt FROM pool WHERE a IS NOT NULL GROUP BY a)"""


def _pool(spark: SparkSession, folder: str) -> DataFrame:
    one = lambda t, c: read(spark, folder, t).select(F.col(c).alias("address"))
    rows = one("ops_location", "OPS_STREET").unionAll(one("soldto_location", "OPS_STREET")).unionAll(one("dim_location_soldto", "STREET"))
    return rows.select(F.trim(F.regexp_replace("address", r"\s+", " ")).alias("address"))


def _reduced_sql(keep: str, having: str) -> str:
    return f"""(WITH r AS (SELECT scope, address, n, txt, array_to_string(list_filter(tokens, lambda x: {keep}), ' ') AS key FROM f),
  k AS (SELECT r.* FROM r WHERE key <> '' AND (scope, key) IN (SELECT scope, txt FROM f)),
  b AS (SELECT scope, key, arg_max(address, rk) AS address, arg_max(txt, rk) AS txt, count(*) AS size FROM (SELECT *, -row_number() OVER (PARTITION BY scope, key ORDER BY n DESC, address) AS rk FROM k) GROUP BY scope, key)
  SELECT scope, key, address FROM b WHERE txt <> key {having})"""


_TOKENS_SQL = _reduced_sql(f"NOT list_contains({_ROADS}, x)", "")
_NUMBERS_SQL = _reduced_sql("NOT regexp_matches(x, '^[0-9]+$')", "AND size < 3")
_ORDER_SQL = """(SELECT scope, txt AS key, best AS address FROM (SELECT scope, address, txt, first_value(address) OVER (PARTITION BY scope, array_to_string(list_sort(tokens), ' ') ORDER BY n DESC, address) AS best FROM f) WHERE address <> best)"""
_DICT_SQL = f"(SELECT scope, key, arg_min(address, rank) AS address FROM (SELECT *, 2 AS rank FROM {_TOKENS_SQL} UNION ALL SELECT *, 1 FROM {_NUMBERS_SQL} UNION ALL SELECT *, 0 FROM {_ORDER_SQL}) GROUP BY scope, key)"
#: CTEs d, w and fixes: what following the rules of `f` leads to, in each scope.
_FIX_SQL = f"""d AS (SELECT scope, key, array_to_string(list_filter(string_split_regex(address, '\\s+'), lambda x: x <> ''), ' ') AS nxt FROM {_DICT_SQL}),
w(scope, key, top, seen, looped) AS (SELECT scope, key, nxt, [key], nxt = key FROM d WHERE nxt <> key UNION ALL SELECT w.scope, w.key, d.nxt, list_append(w.seen, w.top), list_contains(w.seen, d.nxt) OR d.nxt = w.top FROM w JOIN d ON w.scope = d.scope AND w.top = d.key WHERE NOT w.looped AND d.nxt <> d.key),
fixes AS (SELECT scope, key, arg_max(top, len(seen)) AS address FROM w GROUP BY scope, key HAVING NOT bool_or(looped))"""


def _freq(spark: SparkSession, folder: str) -> DataFrame:
    return stats_dict.frequencies(_pool(spark, folder), "address")


@query(f"WITH {_POOL} SELECT key, address FROM {_TOKENS_SQL}")
def missing_token_dict(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses without their suffix, and the usual ones with it."""
    return stats_dict.missing_tokens(_freq(spark, folder), SUFFIXES).drop("scope")


@query(f"WITH {_POOL} SELECT key, address FROM {_NUMBERS_SQL}")
def missing_number_dict(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses without their number, and the only ones with it."""
    return stats_dict.missing_numbers(_freq(spark, folder)).drop("scope")


@query(f"WITH {_POOL} SELECT key, address FROM {_ORDER_SQL}")
def order_switch_dict(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses whose words stand in an unusual order, and the usual one."""
    return stats_dict.switched_order(_freq(spark, folder)).drop("scope")


@query(f"WITH RECURSIVE {_POOL}, {_FIX_SQL} SELECT key, address FROM fixes")
def dict_fixpoint(spark: SparkSession, folder: str) -> DataFrame:
    """What following all repairs of an address leads to."""
    return stats_dict.resolved(stats_dict.dictionary(_freq(spark, folder), SUFFIXES)).drop("scope")


@query(f"SELECT DISTINCT ID, array_to_string(list_transform(list_filter({_TOKENS.format('STREET')}, lambda t: NOT list_contains({_list(A.IGNORED)}, lower(t))), lambda t: coalesce({_map(RULES.suffixes | A.DIRECTIONS)}[lower(t)], t)), ' ') AS text FROM dim_location_sales_order WHERE STREET IS NOT NULL")
def token_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Streets cut into words, those that say nothing left out, those of the dictionaries replaced."""
    return read(spark, folder, "dim_location_sales_order").where("STREET is not null").select("ID", A.normalised(F.col("STREET"), RULES).alias("text")).distinct()


_BOXED = r"^\s*p[\s.]*o[\s.]*b[\s.]*(?:[o0][\s.]*)?(?:x[\s.]*)?\d+\s*$"
_ROAD = r"^(.*)\si(?:n?t?e?r?s?t?a?t?e?)\s(\d+)"
_SPECIAL = rf"CASE WHEN regexp_matches(r, '(?i){_BOXED}') THEN 'PO Box ' || regexp_extract(r, '(\d+)\s*$', 1) ELSE r END"
_OF_ROAD = rf"CASE WHEN regexp_matches({{0}}, '(?i){_ROAD}') THEN regexp_extract({{0}}, '(?i){_ROAD}', 1) || ' Interstate ' || regexp_extract({{0}}, '(?i){_ROAD}', 2) ELSE {{0}} END"


@query(f"SELECT DISTINCT ID, {_SPECIAL} AS address FROM (SELECT ID, {_OF_ROAD.format('STREET')} AS r FROM dim_location_sales_order)")
def pobox_interstate(spark: SparkSession, folder: str) -> DataFrame:
    """Post-office boxes and interstates of all streets in one spelling."""
    return read(spark, folder, "dim_location_sales_order").select("ID", A.special(F.col("STREET")).alias("address")).distinct()


def _crossing(c: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({c}, '{p}')" for p in A.INTERSECTIONS) + ")"


@query(f"SELECT DISTINCT ID, STREET AS street, {_crossing('STREET')} AS is_intersection FROM dim_location_sales_order WHERE STREET IS NOT NULL")
def intersection_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Which streets name a crossing."""
    return read(spark, folder, "dim_location_sales_order").where("STREET is not null").select("ID", F.col("STREET").alias("street")).distinct().withColumn("is_intersection", A.is_intersection(F.col("street")))


def _ordinal_sql(c: str, roads: str) -> str:
    for word, end in (("Street", "st"), ("Road", "rd"), ("Th", "th"), ("Nd", "nd")):
        c = rf"regexp_replace({c}, '(\d+) {word} ({roads})', '\1{end} \2', 'g')"
    return c


@query(f"SELECT DISTINCT ID, {_ordinal_sql('STREET', 'Avenue|Road|Street')} AS street FROM dim_location_soldto")
def ordinal_fix(spark: SparkSession, folder: str) -> DataFrame:
    """Streets with the ordinal ends mended that a dictionary broke."""
    return read(spark, folder, "dim_location_soldto").select("ID", A.ordinals(F.col("STREET"), ["Avenue", "Road", "Street"]).alias("street")).distinct()


def _valid_sql(c: str, crossings: bool) -> str:
    words = f"list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"
    known = _list(w.lower() for w in [*SQL_SUFFIXES, *SQL_SPANISH, *SQL_DIRECTIONS, "broadway", "interstate", "highway", "concourse"])
    number = rf"coalesce(regexp_matches({words}[1], '(?i)^(\d+|[NSEW]?\d*[NSEW]\d+.*)$'), false)"
    return f"({c} <> '' AND ((list_has_any(list_transform({words}, lambda x: lower(x)), {known}) AND {number}) OR starts_with({c}, 'PO Box')" + (f" OR {_crossing(c)}" if crossings else "") + "))"


@query(f"SELECT DISTINCT ID, OPS_STREET FROM soldto_location WHERE {_valid_sql('OPS_STREET', True)}")
def valid_address_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The addresses that can be right."""
    return read(spark, folder, "soldto_location").where(A.is_valid(F.col("OPS_STREET"), True, RULES)).select("ID", "OPS_STREET").distinct()


def _without_garbage_sql(c: str) -> str:
    k = f"list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"
    last = f"list_max(list_filter(range(1, len({k}) + 1), lambda i: list_contains({_list(SQL_SUFFIXES + SQL_DIRECTIONS)}, {k}[i])))"
    kept = _list(["state", "route", "county", "fm", "highway", "interstate", *(w.lower() for w in SQL_SPANISH)])
    return (
        f"CASE WHEN len({k}) < 2 OR list_has_any(list_transform({k}, lambda x: lower(x)), {kept}) OR list_contains({_EVERY}, {k}[-1]) OR list_contains({_DIRS}, {k}[2]) OR NOT list_has_any({k}, {_list(SQL_SUFFIXES + SQL_SPANISH + SQL_DIRECTIONS)}) "
        f"OR {last} IS NULL THEN {c} ELSE array_to_string({k}[1:{last}], ' ') END"
    )


@query(f"SELECT DISTINCT ID, {_without_garbage_sql('STREET')} AS street FROM dim_location_soldto WHERE STREET IS NOT NULL")
def garbage_after_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Streets without what follows their suffix."""
    return read(spark, folder, "dim_location_soldto").where("STREET is not null").select("ID", A.without_garbage(F.col("STREET"), RULES).alias("street")).distinct()


def _inferred(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "dim_location_sales_order").select("ID", "STREET_NUM", "STREET", *curate.OTHERS).distinct()
    return rows.withColumn("a", A.infer_columns(F.col("STREET_NUM"), F.col("STREET"), [F.col(c) for c in curate.OTHERS], RULES))


@query(f"WITH {_inferred_sql(f'SELECT DISTINCT ID, STREET_NUM AS number, STREET AS street, ' + ', '.join(curate.OTHERS) + ' FROM dim_location_sales_order', curate.OTHERS)} SELECT ID, address, lvl1, lvl2 FROM inferred")
def sublocation_split(spark: SparkSession, folder: str) -> DataFrame:
    """Street and two levels of sub-location of every raw record."""
    return _inferred(spark, folder).select("ID", "a.address", "a.lvl1", "a.lvl2")


_LETTERS = "'[' || array_to_string(string_split(upper(t), ''), '][') || ']'"
_MARKED = f"CASE WHEN len(k) = 0 OR map_contains({_map(A.MARKERS)}, upper(k[-1])) THEN NULL ELSE '\\b(' || array_to_string(list_transform(k, lambda t: coalesce({_map(A.MARKERS)}[upper(t)], {_LETTERS})), '[\\s.]?[\\s-]?[\\s:]?[\\s#]?') || ')\\b' END"
_PIECES = r"regexp_extract_all(coalesce({0}, ''), '[&!?$%\[\]{{}}<>]|[^\s&!?$%\[\]{{}}<>]+')"


@query(f"SELECT OPS_SUBLOCATION, {_MARKED} AS marker FROM (SELECT DISTINCT OPS_SUBLOCATION, {_PIECES.format('OPS_SUBLOCATION')} AS k FROM ops_location)")
def ops_markers(spark: SparkSession, folder: str) -> DataFrame:
    """The pattern that finds each sub-location in raw texts."""
    return read(spark, folder, "ops_location").select("OPS_SUBLOCATION").distinct().withColumn("marker", A.marker(F.col("OPS_SUBLOCATION")))


def _precurated(spark: SparkSession, folder: str, table: str = "dim_location_sales_order", by: tuple[str, ...] = ("ORGANIZATION_ID", "STATE")) -> DataFrame:
    rows = read(spark, folder, table)
    if table == "dim_location_soldto":  # the table states no organisation: that of the location it refers to, if any
        rows = rows.withColumnsRenamed({"REGION": "STATE"})
        of = read(spark, folder, "soldto_location").groupBy(key_form(F.col("ID")).alias("_k")).agg(F.min("ORGANIZATION_ID").alias("ORGANIZATION_ID"))
        rows = rows.withColumn("_k", key_form(F.col("OPS_LOCATION_ID"))).join(of, "_k", "left").drop("_k")
    org = read(spark, folder, "organization").select(F.col("ID").alias("ORGANIZATION_ID"), "ORGANIZATION_NAME")
    return curate.precurate(rows.distinct().join(org, "ORGANIZATION_ID", "left"), by, RULES, False)


def _curated_sql(source: str, others: tuple[str, ...], scope: str, crossings: bool) -> str:
    """CTEs that end in `cur`: the valid rows of `source` (id, number, street, city, state, zip, org, name and others) with
    their curated street `a`, sub-location and marker."""
    roads = "|".join(sorted(SQL_SUFFIXES))
    one = lambda c: f"array_to_string(list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> ''), ' ')"
    return f"""{_inferred_sql(source, others)}, sp0 AS (SELECT *, {scope} AS scope, {_OF_ROAD.format('address')} AS r FROM inferred), sp AS (SELECT *, {_SPECIAL} AS raw FROM sp0),
f AS (SELECT scope, raw AS address, count(*) AS n, list_filter(string_split_regex(raw, '\\s+'), lambda x: x <> '') AS tokens, {one('raw')} AS txt FROM sp WHERE raw <> '' GROUP BY scope, raw), {_FIX_SQL},
fx AS (SELECT sp.*, coalesce(fixes.address, raw) AS fixed FROM sp LEFT JOIN fixes ON fixes.scope = sp.scope AND fixes.key = {one('raw')}),
cur AS (SELECT *, {_ordinal_sql('g', roads)} AS a, {_PIECES.format('lvl1')} AS k FROM (SELECT *, {_without_garbage_sql('fixed')} AS g FROM fx WHERE {_valid_sql('fixed', crossings)}))"""


_TEXT = lambda c, n: f"coalesce({c}, '') AS {n}"
_SALES_ROWS = f"SELECT DISTINCT s.ID AS id, {_TEXT('STREET_NUM', 'number')}, {_TEXT('STREET', 'street')}, {_TEXT('CITY', 'city')}, {_TEXT('STATE', 'state')}, {_TEXT('ZIP5', 'zip')}, ORGANIZATION_ID AS org, ORGANIZATION_NAME AS name, {', '.join(_TEXT('s.' + c, c) for c in curate.OTHERS)}, s.* EXCLUDE (ID, STREET, STREET_NUM, CITY, STATE, ZIP5, ORGANIZATION_ID, {', '.join(curate.OTHERS)}) FROM dim_location_sales_order s LEFT JOIN organization o ON s.ORGANIZATION_ID = o.ID"
_SOLDTO_ROWS = f"""SELECT DISTINCT s.ID AS id, '' AS number, {_TEXT('STREET', 'street')}, {_TEXT('CITY', 'city')}, {_TEXT('REGION', 'state')}, {_TEXT('ZIP5', 'zip')}, l.org, ORGANIZATION_NAME AS name, s.OPS_LOCATION_ID, s.LOADED_AT FROM dim_location_soldto s
  LEFT JOIN (SELECT replace(ID, '-', '') AS k, min(ORGANIZATION_ID) AS org FROM soldto_location GROUP BY 1) l ON l.k = replace(lower(regexp_replace(nullif(trim(s.OPS_LOCATION_ID), ''), '[{{}}\\s]', '', 'g')), '-', '') LEFT JOIN organization o ON l.org = o.ID"""
_SPACED = lambda *cs: "concat_ws(' ', " + ", ".join(f"nullif({c}, '')" for c in cs) + ")"
_HASHED = lambda *cs: "sha256(" + " || ' ' || ".join(f"coalesce({c}, '')" for c in cs) + ")"


@query(f"""WITH RECURSIVE {_curated_sql(_SALES_ROWS, curate.OTHERS, "coalesce(org, chr(2)) || chr(1) || state", True)},
g AS (SELECT a, city, state, zip, lvl1, org, name, min({_MARKED}) AS marker, count(DISTINCT id) AS n FROM cur GROUP BY ALL),
n AS (SELECT *, trim(concat_ws(' ', org, '@', a, lvl1)) AS loc FROM g),
m AS (SELECT *, CASE WHEN marker IS NOT NULL AND count(CASE WHEN marker IS NULL THEN 1 END) OVER w = 1 THEN max(CASE WHEN marker IS NULL THEN loc END) OVER w END AS main FROM n WINDOW w AS (PARTITION BY a, city, state, zip, org, name))
SELECT {_HASHED('name', 'a', 'city', 'state', 'zip', 'lvl1')} AS ID, loc AS OPS_LOC_NAME, main AS MAIN_LOC_NAME, a AS OPS_STREET, lvl1 AS OPS_SUBLOCATION, city AS OPS_CITY, state AS OPS_STATE, zip AS OPS_ZIP5, marker AS OPS_MARKER, marker IS NULL AS IS_ADDRESS, marker IS NOT NULL AS IS_BUILDING, CAST(n AS INTEGER) AS n_records FROM m""")
def curated_sales_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical locations of the sales-order records, their repairs learnt within each organisation and state."""
    out = curate.sales_locations(_precurated(spark, folder), "ID", None, RULES)
    return out.select("ID", "OPS_LOC_NAME", "MAIN_LOC_NAME", "OPS_STREET", "OPS_SUBLOCATION", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", "OPS_MARKER", "IS_ADDRESS", "IS_BUILDING", F.size("DIM_LOCATION_ID").alias("n_records"))


_TITLE = lambda c: f"array_to_string(list_transform(regexp_extract_all({c}, '[\\p{{L}}]+|[^\\p{{L}}]+'), lambda x: upper(x[1]) || lower(x[2:])), '')"
_SOLDTO_SQL = f"""WITH RECURSIVE {_curated_sql(_SOLDTO_ROWS, (), "state", False)},
g AS (SELECT a, {_TITLE('city')} AS city, state, zip, org, name, list(DISTINCT id) AS ids FROM cur GROUP BY a, {_TITLE('city')}, state, zip, org, name)"""
_SOLDTO_ID = _HASHED("name", "a", "city", "state", "zip")


@query(f"{_SOLDTO_SQL} SELECT {_SOLDTO_ID} AS ID, trim({_SPACED('org', chr(39) + '@' + chr(39), 'a', 'city', 'state', 'zip')}) AS OPS_LOC_NAME, a AS OPS_STREET, city AS OPS_CITY, state AS OPS_STATE, zip AS OPS_ZIP5, CAST(len(ids) AS INTEGER) AS n_records FROM g")
def curated_soldto(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical locations of the sold-to records."""
    out = curate.soldto_locations(_precurated(spark, folder, "dim_location_soldto", ("STATE",)), "ID", None, RULES)
    return out.select("ID", "OPS_LOC_NAME", "OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", F.size("DIM_LOCATION_ID").alias("n_records"))


@query(f"{_SOLDTO_SQL} SELECT {_SOLDTO_ID} AS OPS_LOCATION_ID, unnest(ids) AS DIM_LOCATION_ID, 1.0::DOUBLE AS OPS_MATCH_SCORE FROM g")
def curated_associations(spark: SparkSession, folder: str) -> DataFrame:
    """Every sold-to record and the location that stands for it."""
    return curate.associations(curate.soldto_locations(_precurated(spark, folder, "dim_location_soldto", ("STATE",)), "ID", None, RULES))


@query("""WITH p AS (SELECT DISTINCT ID, ORGANIZATION_ID AS g, LATITUDE AS la, LONGITUDE AS lo FROM ops_location WHERE LATITUDE BETWEEN -90 AND 90 AND LONGITUDE BETWEEN -180 AND 180 AND ORGANIZATION_ID IS NOT NULL),
e AS (SELECT a.ID AS a, b.ID AS b FROM p a JOIN p b ON a.g = b.g AND a.ID <> b.ID WHERE 2 * 6371007.2 * asin(sqrt(least(1.0, power(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * power(sin(radians(b.lo - a.lo) / 2), 2)))) < 100)
SELECT a AS id, count(*) AS n FROM e GROUP BY a""")
def neighbours_within(spark: SparkSession, folder: str) -> DataFrame:
    """How many other locations of its organisation lie within a hundred metres of each."""
    p = read(spark, folder, "ops_location").where("LATITUDE between -90 and 90 and LONGITUDE between -180 and 180 and ORGANIZATION_ID is not null").select("ID", "ORGANIZATION_ID", "LATITUDE", "LONGITUDE").distinct()
    return geo.neighbour_counts(p, "ID", "ORGANIZATION_ID")


@query("""WITH RECURSIVE p AS (SELECT DISTINCT ID, ORGANIZATION_ID AS g, LATITUDE AS la, LONGITUDE AS lo FROM ops_location WHERE LATITUDE BETWEEN -90 AND 90 AND LONGITUDE BETWEEN -180 AND 180 AND ORGANIZATION_ID IS NOT NULL),
e AS (SELECT a.ID AS a, b.ID AS b FROM p a JOIN p b ON a.g = b.g AND a.ID <> b.ID WHERE 2 * 6371007.2 * asin(sqrt(least(1.0, power(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * power(sin(radians(b.lo - a.lo) / 2), 2)))) < 100),
w(a, b) AS (SELECT a, a FROM e UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a)
SELECT a AS id, min(b) AS cluster FROM w GROUP BY a""")
def location_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """The single-linkage cluster of every location that has a neighbour."""
    return geo.clusters(read(spark, folder, "ops_location"), "ID", "ORGANIZATION_ID")


_CLUSTERED = """p AS (SELECT DISTINCT ID, ORGANIZATION_ID AS g, LATITUDE AS la, LONGITUDE AS lo FROM ops_location WHERE IS_RESIDENTIAL = FALSE AND LATITUDE BETWEEN -90 AND 90 AND LONGITUDE BETWEEN -180 AND 180 AND ORGANIZATION_ID IS NOT NULL),
e AS (SELECT a.ID AS a, b.ID AS b FROM p a JOIN p b ON a.g = b.g AND a.ID <> b.ID WHERE 2 * 6371007.2 * asin(sqrt(least(1.0, power(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * power(sin(radians(b.lo - a.lo) / 2), 2)))) < 100),
w(a, b) AS (SELECT a, a FROM e UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a), c AS (SELECT a AS id, min(b) AS cluster FROM w GROUP BY a), m AS (SELECT o.*, c.cluster FROM ops_location o JOIN c ON o.ID = c.id WHERE o.IS_RESIDENTIAL = FALSE)"""
_MODE = lambda c: f"(SELECT v FROM (SELECT {c} AS v, count(*) AS k FROM m x WHERE x.cluster = q.cluster AND x.ORGANIZATION_ID = q.g AND {c} IS NOT NULL GROUP BY 1 ORDER BY k DESC, v LIMIT 1))"


@query(f"""WITH RECURSIVE {_CLUSTERED}, q AS (SELECT ORGANIZATION_ID AS g, cluster, count(DISTINCT ID)::INTEGER AS n, CAST(sum(CAST(LATITUDE AS DECIMAL(18,9))) AS DOUBLE) / count(LATITUDE) AS la, CAST(sum(CAST(LONGITUDE AS DECIMAL(18,9))) AS DOUBLE) / count(LONGITUDE) AS lo FROM m GROUP BY 1, 2),
r AS (SELECT *, {_MODE('OPS_STREET')} AS st, {_MODE('OPS_CITY')} AS ci, {_MODE('OPS_STATE')} AS sta, {_MODE('OPS_ZIP5')} AS zi, {_MODE('ORGANIZATION_NAME')} AS nm FROM q)
SELECT sha256('site ' || cluster) AS ID, concat_ws(' ', nm, sta, 'P' || left(sha1(cluster), 8), st, ci) AS OPS_LOC_NAME, st AS OPS_STREET, ci AS OPS_CITY, sta AS OPS_STATE, zi AS OPS_ZIP5, n AS n_children, floor(la * 1e6 + 0.5) / 1e6 AS LATITUDE, floor(lo * 1e6 + 0.5) / 1e6 AS LONGITUDE FROM r""")
def site_parents(spark: SparkSession, folder: str) -> DataFrame:
    """A parent record for each cluster of locations."""
    out = geo.sites(read(spark, folder, "ops_location"))
    return out.select("ID", "OPS_LOC_NAME", "OPS_STREET", "OPS_CITY", "OPS_STATE", "OPS_ZIP5", F.size("children").alias("n_children"), *[(F.floor(F.col(c) * F.lit(1e6) + 0.5) / F.lit(1e6)).alias(c) for c in ("LATITUDE", "LONGITUDE")])


_CACHE = """cache AS (SELECT lower(OPS_STREET) AS ops_street, OPS_CITY AS ops_city, OPS_STATE AS ops_state, OPS_ZIP5 AS ops_zip5, GEOCODE_ACCURACY AS accuracy, LATITUDE AS lat, LONGITUDE AS lon FROM soldto_location WHERE DELETED_AT IS NULL AND LATITUDE IS NOT NULL AND NOT isnan(GEOCODE_ACCURACY)),
asked AS (SELECT DISTINCT coalesce(lower(STREET), '') AS ops_street, coalesce(CITY, '') AS ops_city, coalesce(REGION, '') AS ops_state, coalesce(ZIP5, '') AS ops_zip5 FROM dim_location_soldto)"""


@query(f"""WITH {_CACHE}, best AS (SELECT coalesce(ops_street, '') AS ops_street, coalesce(ops_city, '') AS ops_city, coalesce(ops_state, '') AS ops_state, coalesce(ops_zip5, '') AS ops_zip5, max(coalesce(accuracy, -1)) AS accuracy FROM cache GROUP BY 1, 2, 3, 4)
SELECT a.*, b.ops_street IS NOT NULL AS hit, nullif(b.accuracy, -1.0) AS accuracy FROM asked a LEFT JOIN best b ON a.ops_street = b.ops_street AND a.ops_city = b.ops_city AND a.ops_state = b.ops_state AND a.ops_zip5 = b.ops_zip5""".replace("nullif(b.accuracy, -1.0)", "b.accuracy"))
def geocode_cache_split(spark: SparkSession, folder: str) -> DataFrame:
    """Which sold-to addresses a cache of geocodes knows, and how accurately."""
    keys = ["ops_street", "ops_city", "ops_state", "ops_zip5"]
    cache = read(spark, folder, "soldto_location").where("DELETED_AT is null and LATITUDE is not null and not isnan(GEOCODE_ACCURACY)")
    cache = cache.select(F.lower("OPS_STREET").alias("ops_street"), F.col("OPS_CITY").alias("ops_city"), F.col("OPS_STATE").alias("ops_state"), F.col("OPS_ZIP5").alias("ops_zip5"), F.coalesce("GEOCODE_ACCURACY", F.lit(-1.0)).alias("accuracy"), F.col("LATITUDE").alias("lat"), F.col("LONGITUDE").alias("lon"), F.col("GEOCODE_LEVEL").alias("type"), F.lit("").alias("formatted_address"))
    asked = read(spark, folder, "dim_location_soldto").select(F.lower("STREET").alias("ops_street"), F.col("CITY").alias("ops_city"), F.col("REGION").alias("ops_state"), F.col("ZIP5").alias("ops_zip5"))
    hits, misses = geo.split_by_cache(asked, cache, keys)
    return hits.select(*keys, F.lit(True).alias("hit"), "accuracy").unionByName(misses.select(*keys, F.lit(False).alias("hit"), F.lit(None).cast("double").alias("accuracy")))


@query("""SELECT o.ID, coalesce(l.r, false) AS is_residential FROM ops_location o LEFT JOIN (SELECT OPS_STREET, OPS_CITY, bool_or(coalesce(GEOCODE_LEVEL = 'place', false) OR coalesce(GEOCODE_ACCURACY = 1, false)) AS r FROM soldto_location GROUP BY 1, 2) l ON o.OPS_STREET = l.OPS_STREET AND o.OPS_CITY = l.OPS_CITY""")
def residential_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Locations flagged where either provider says so, by a lookup on street and city."""
    lookup = read(spark, folder, "soldto_location").select("OPS_STREET", "OPS_CITY", F.when(F.col("GEOCODE_LEVEL") == "place", "R").alias("svs_rdi"), F.when(F.col("GEOCODE_ACCURACY") == 1, "Residential").alias("ups_rdi"))
    return geo.residential(read(spark, folder, "ops_location"), lookup, ["OPS_STREET", "OPS_CITY"]).select("ID", F.col("IS_RESIDENTIAL").alias("is_residential"))


def _third_party(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "dim_location_dnb").where("DELETED_AT is null").select("ID", F.col("PHYS_ST_ABRV").alias("STATE"), F.left(F.trim("PHYS_ZIP5"), F.lit(3)).alias("ZIP3"), text.location_string("dnb").alias("text")).distinct()


def _canonical(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return read(spark, folder, "ops_location").where("IS_ADDRESS and DELETED_AT is null").select("ID", F.col("OPS_STATE").alias("STATE"), F.left("OPS_ZIP5", F.lit(3)).alias("ZIP3"), text.location_string("ops_no_sublocation").alias("text"), *more).distinct()


def _text_sql(*fields: str) -> str:
    return f"concat_ws(' ', {', '.join(f'''nullif({c}, '')''' for c in fields)})"


def _scores_sql(dim: str, ops: str, block: tuple[str, ...]) -> str:
    """CTEs that end in `scored` (l, r, score): trigram TF-IDF products of all rows of `dim` and `ops` (ID, block columns,
    text) that share a block and a trigram, weights by `dim`."""
    b = ", ".join(block)
    of = lambda t, k: f"{k}t AS (SELECT ID, {b}{', ' if b else ''}unnest(list_transform(range(1, greatest(length(text) - 1, 1)), lambda i: substring(lower(text), i, 3))) AS token FROM {t} WHERE length(text) > 2)"
    side = lambda k: (
        f"{k}c AS (SELECT ID, {b}{', ' if b else ''}token, count(*) * any_value(idf) AS w FROM {k}t JOIN v USING (token) GROUP BY ALL), {k}n AS (SELECT ID{', ' if b else ''}{b}, sqrt(sum(w * w)) AS norm FROM {k}c GROUP BY ALL), "
        f"{k}w AS (SELECT {k}c.*, w / norm AS x FROM {k}c JOIN {k}n USING (ID{', ' if b else ''}{b}))"
    )
    return (
        f"dim AS ({dim}), ops AS ({ops}), {of('dim', 'dd')}, {of('ops', 'oo')}, v AS (SELECT token, ln((1 + (SELECT count(DISTINCT ID) FROM dim)) / (1 + count(DISTINCT ID))) + 1 AS idf FROM ddt GROUP BY token), {side('dd')}, {side('oo')}, "
        f"scored AS (SELECT ddw.ID AS l, oow.ID AS r, {', '.join('ddw.' + c for c in block)}{', ' if b else ''}round(sum(ddw.x * oow.x), 9) AS score FROM ddw JOIN oow USING ({b}{', ' if b else ''}token) GROUP BY ALL)"
    )


_DNB_ROWS = f"SELECT DISTINCT ID, PHYS_ST_ABRV AS STATE, left(trim(PHYS_ZIP5), 3) AS ZIP3, {_text_sql('PHYS_STRT_AD', 'PHYS_CTY', 'PHYS_ST_ABRV', 'PHYS_ZIP5')} AS text FROM dim_location_dnb WHERE DELETED_AT IS NULL"
_OPS_ROWS = f"SELECT DISTINCT ID, OPS_STATE AS STATE, left(OPS_ZIP5, 3) AS ZIP3, {_text_sql('OPS_STREET', 'OPS_CITY', 'OPS_STATE', 'OPS_ZIP5')} AS text FROM ops_location WHERE IS_ADDRESS AND DELETED_AT IS NULL"
_DNB_SCORES = _scores_sql(_DNB_ROWS, _OPS_ROWS, ("STATE", "ZIP3"))
_BEST_OF = "SELECT l, r, score FROM scored WHERE score >= {1} QUALIFY row_number() OVER (PARTITION BY {0} ORDER BY score DESC, {2}) = 1"


@query(f"WITH {_DNB_SCORES} SELECT r AS ops_id, l AS dnb_id, round(score, 6) AS score FROM ({_BEST_OF.format('r', match.THRESHOLD, 'l')})")
def match_dnb(spark: SparkSession, folder: str) -> DataFrame:
    """The most alike third-party record of every canonical address of its state and zip area."""
    found = match.rank(_third_party(spark, folder), _canonical(spark, folder), F.col("text"), F.col("text"), ["STATE", "ZIP3"], per_ops=True, threshold=match.THRESHOLD)
    return found.select(F.col("right_id").alias("ops_id"), F.col("left_id").alias("dnb_id"), F.round("score", 6).alias("score"))


@query(f"WITH {_DNB_SCORES} SELECT l AS dnb_id, r AS ops_id, round(score, 6) AS score FROM ({_BEST_OF.format('l', match.THRESHOLD, 'r')})")
def match_best_ops(spark: SparkSession, folder: str) -> DataFrame:
    """The most alike canonical address of every third-party record of its state and zip area."""
    found = match.rank(_third_party(spark, folder), _canonical(spark, folder), F.col("text"), F.col("text"), ["STATE", "ZIP3"], threshold=match.THRESHOLD)
    return found.select(F.col("left_id").alias("dnb_id"), F.col("right_id").alias("ops_id"), F.round("score", 6).alias("score"))


_WORDS = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"


@query(f"""WITH o AS (SELECT DISTINCT ID AS id, ORGANIZATION_NAME AS name FROM organization), t AS (SELECT id, unnest({_WORDS.format('name')}) AS token FROM o), v AS (SELECT token, ln((1 + (SELECT count(*) FROM o)) / (1 + count(DISTINCT id))) + 1 AS idf FROM t GROUP BY token),
w AS (SELECT id, token, count(*) * any_value(idf) AS w FROM t JOIN v USING (token) GROUP BY id, token), n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM w GROUP BY id)
SELECT id, token, round(w / norm, 6) AS weight FROM w JOIN n USING (id)""")
def tfidf_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The weights of the words of organisations' names."""
    rows = read(spark, folder, "organization").select("ID", "ORGANIZATION_NAME").distinct()
    return match.tfidf(rows, "ID", match.word_grams(F.col("ORGANIZATION_NAME"))).select("id", "token", F.round("weight", 6).alias("weight"))


@query(f"""WITH o AS (SELECT ID AS id, ORGANIZATION_NAME AS name FROM organization), t AS (SELECT id, unnest({_WORDS.format('name')}) AS token FROM o), v AS (SELECT token, ln((1 + (SELECT count(DISTINCT id) FROM o)) / (1 + count(DISTINCT id))) + 1 AS idf FROM t GROUP BY token),
c AS (SELECT id, token, count(*) * any_value(idf) AS w FROM t JOIN v USING (token) GROUP BY id, token), n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM c GROUP BY id), x AS (SELECT id, token, w / norm AS x FROM c JOIN n USING (id)),
s AS (SELECT a.id, b.id AS other, round(sum(a.x * b.x), 9) AS score FROM x a JOIN x b ON a.token = b.token AND a.id <> b.id GROUP BY 1, 2), k AS (SELECT * FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 5),
votes AS (SELECT k.id, string_split(name, ' ')[-1] AS label, round(sum(score), 9) AS votes FROM k JOIN o ON k.other = o.id GROUP BY 1, 2)
SELECT id, label, round(votes, 6) AS votes FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1""")
def knn_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Organisations' kind of business by the votes of their nearest names, from the last word of every other one."""
    rows = read(spark, folder, "organization").select(F.col("ID").alias("id"), "ORGANIZATION_NAME")
    label = F.element_at(F.split("ORGANIZATION_NAME", " "), -1)
    weights = match.tfidf(rows, "id", match.word_grams(F.col("ORGANIZATION_NAME")))
    return match.neighbour_votes(rows.select("id", label.alias("label")), weights, 5, itself=False).select("id", "label", F.round("votes", 6).alias("votes"))


@query(f"""WITH d AS (SELECT DISTINCT ID, ORGANIZATION_ID AS g, STATE, upper({_text_sql('DEPARTMENT', 'ATTENTION', 'SUPPLEMENTAL', 'RECEIVER', 'STREET_NUM', 'STREET', 'CITY', 'STATE', 'ZIP5')}) AS text FROM dim_location_sales_order),
o AS (SELECT DISTINCT ID, g, STATE, {_MARKED} AS marker FROM (SELECT ID, ORGANIZATION_ID AS g, OPS_STATE AS STATE, {_PIECES.format('OPS_SUBLOCATION')} AS k FROM ops_location WHERE IS_BUILDING))
SELECT DISTINCT d.ID AS dim_id, o.ID AS ops_id FROM d JOIN o USING (g, STATE) WHERE marker IS NOT NULL AND regexp_matches(text, '(?i)' || marker)""")
def marker_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records in whose text the marker of a sub-location of their organisation and state is found."""
    dim = read(spark, folder, "dim_location_sales_order").select("ID", "ORGANIZATION_ID", "STATE", F.upper(text.location_string("simple")).alias("text")).distinct()
    ops = read(spark, folder, "ops_location").where("IS_BUILDING").select("ID", "ORGANIZATION_ID", F.col("OPS_STATE").alias("STATE"), A.marker(F.col("OPS_SUBLOCATION")).alias("marker")).distinct()
    return match.marked(dim, ops, "text", "marker", ["ORGANIZATION_ID", "STATE"]).distinct()


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two texts: one row of lengths after the other."""
    row = "list_reduce(range(1, length({1}) + 1), lambda now, j: list_append(now, greatest(now[-1], was[j + 1], was[j] + CAST(substring({1}, j, 1) = c AS INTEGER))), [0])".replace("{1}", b)
    return f"coalesce(list_reduce(list_transform(range(1, length({a}) + 1), lambda i: substring({a}, i, 1)), lambda was, c: {row}, list_resize([0], length({b}) + 1, 0))[-1], 0)"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100 ELSE CAST(round_even(200 * {_lcs(a, b)} / (length({a}) + length({b})), 0) AS INTEGER) END"


_SPLIT = "list_distinct(list_filter(string_split_regex({0}, '\\s+'), lambda x: x <> ''))"
_JOINED = "trim(array_to_string(list_concat(z, list_sort({0})), ' '))"


@query(f"""WITH o AS (SELECT ID AS org, upper(ORGANIZATION_NAME) AS listed FROM organization), r AS (SELECT a.ID, upper(a.ACCOUNT_NAME) AS typed, listed FROM organization_soldto_account a JOIN o ON a.ORGANIZATION_ID = o.org),
w AS (SELECT *, {_SPLIT.format('typed')} AS x, {_SPLIT.format('listed')} AS y FROM r), v AS (SELECT *, list_sort(list_intersect(x, y)) AS z, list_filter(x, lambda t: NOT list_contains(y, t)) AS dx, list_filter(y, lambda t: NOT list_contains(x, t)) AS dy FROM w),
u AS (SELECT *, array_to_string(z, ' ') AS b, {_JOINED.format('dx')} AS p, {_JOINED.format('dy')} AS q FROM v)
SELECT ID, {_ratio('typed', 'listed')} AS ratio, CASE WHEN len(z) > 0 AND (len(dx) = 0 OR len(dy) = 0) THEN 100 ELSE greatest({_ratio('p', 'q')}, CASE WHEN len(z) > 0 THEN greatest({_ratio('b', 'p')}, {_ratio('b', 'q')}) ELSE 0 END) END AS token_set_ratio FROM u""")
def fuzzy_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Two similarities of typed names and the organisation's they are linked to."""
    names = read(spark, folder, "organization").select(F.col("ID").alias("ORGANIZATION_ID"), F.upper("ORGANIZATION_NAME").alias("listed"))
    rows = read(spark, folder, "organization_soldto_account").join(names, "ORGANIZATION_ID").select("ID", F.upper("ACCOUNT_NAME").alias("typed"), "listed")
    return rows.select("ID", text.ratio("typed", "listed").alias("ratio"), text.token_set_ratio("typed", "listed").alias("token_set_ratio"))


@query(r"""SELECT doc_id, length(text) AS n_chars, len(regexp_extract_all(text, '[A-Z]')) AS n_capitals, len(list_filter(string_split_regex(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '')) AS n_words, len(regexp_extract_all(text, '!')) AS n_exclamations, len(regexp_extract_all(text, '\?')) AS n_questions FROM documents""")
def text_features(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that describe every document."""
    kinds = {k: v.cast("long").alias(k) for k, v in text.features(F.col("text")).items() if k in ("n_chars", "n_capitals", "n_words", "n_exclamations", "n_questions")}
    return read(spark, folder, "documents").select("doc_id", *kinds.values())


@query(f"SELECT ID, {_TITLE('CITY')} AS city FROM dim_location_soldto")
def title_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Raw cities in title case."""
    return read(spark, folder, "dim_location_soldto").select("ID", text.title_case(F.col("CITY")).alias("city"))


@query("SELECT ID, coalesce(LATITUDE, 0.0) AS lat, coalesce(LONGITUDE, 0.0) AS lon FROM ops_location")
def parsed_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Coordinates read from a text of longitude and latitude, as every location has them."""
    shown = F.concat(F.lit("("), F.col("LONGITUDE").cast("string"), F.lit(", "), F.col("LATITUDE").cast("string"), F.lit(")"))
    return read(spark, folder, "ops_location").withColumn("c", text.coordinates(shown)).select("ID", "c.lat", "c.lon")


@query("""SELECT ID, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(lower(concat_ws(' ', nullif(STREET, ''), nullif(CITY, ''))), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: CASE WHEN x = 'st' THEN 'street' ELSE x END), lambda x: x <> '' AND x <> 'the'))), ' ') AS tokens FROM dim_location_soldto""")
def location_token_sets(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct words of street and city."""
    words = text.location_tokens(("STREET", "CITY"), ("the",), {"st": "street"})
    return read(spark, folder, "dim_location_soldto").select("ID", F.array_join(F.array_sort(words), " ").alias("tokens"))


@query("""WITH p AS (SELECT o_orderpriority AS t, CASE WHEN o_totalprice > 250000 THEN '1-URGENT' ELSE o_orderpriority END AS p FROM orders),
s AS (SELECT l, sum(t) AS t, sum(p) AS p, sum(h) AS h FROM (SELECT t AS l, 1 AS t, 0 AS p, 0 AS h FROM p UNION ALL SELECT p, 0, 1, CASE WHEN t = p THEN 1 ELSE 0 END FROM p) GROUP BY l)
SELECT round(sum(t * 2 * h / (t + p)) / sum(t), 9) AS f1, CAST(sum(t) AS BIGINT) AS n FROM s""")
def weighted_f1(spark: SparkSession, folder: str) -> DataFrame:
    """The weighted F1 score of a rule that predicts orders' priority."""
    rows = read(spark, folder, "orders").withColumn("p", F.when(F.col("o_totalprice") > 250000, "1-URGENT").otherwise(F.col("o_orderpriority")))
    return match.weighted_f1(rows, "o_orderpriority", "p").select(F.round("f1", 9).alias("f1"), "n")
