"""Queries of the general data problems: units (p1), copies (p2), orphan references (p6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowloom.operators import units
from flowloom.operators.copydiff import factor_copy_differences
from flowloom.operators.orphans import catalogue_orphans, orphans_by_month
from flowloom.operators.units import common_factors, contradicting_factors
from flowloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return contradicting_factors(table(spark, root, "flowmap"), table(spark, root, "unit_conversion"))


def p1_common_factors(spark: SparkSession, root: str) -> DataFrame:
    """Every entry of flowmap with its factor in common units (null where it can't be read)."""
    df = table(spark, root, "flowmap").select("entry_id", "source_unit", "target_unit", "conversion_factor", "note")
    return common_factors(df).select("entry_id", "source_kind", "target_kind", "common_factor")


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return factor_copy_differences(table(spark, root, "cf_flow_join"), table(spark, root, "cf_flow_join_copy"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return catalogue_orphans(*[table(spark, root, t) for t in ("mapping", "flow_records", "biosphere_catalog", "deletion")])


def p6_by_month(spark: SparkSession, root: str) -> DataFrame:
    return orphans_by_month(p6_found(spark, root))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_common_factors, p2_found, p6_found, p6_by_month)}

_SQL_P2_SIDE = """
  select distinct run_id, method_slug, lower({t_code}) as code, {texts},
    nullif(array_to_string(list_transform(categories, lambda x: coalesce(regexp_replace(x, '^[\\s\\x{{00A0}}\\x{{2009}}]+|[\\s\\x{{00A0}}\\x{{2009}}]+$', '', 'g'), '')), chr(1)), '') as categories,
    case when isnan(sp_cf) then null else sp_cf end as sp_cf, case when isnan(ef_cf) then null else ef_cf end as ef_cf
  from {table}"""
_STRIP = "nullif(regexp_replace({c}, '^[\\s\\x{{00A0}}\\x{{2009}}]+|[\\s\\x{{00A0}}\\x{{2009}}]+$', '', 'g'), '')"
_P2_TEXTS = ["db", "name", "cas", "sp_match_provenance", "sp_name", "sp_compartment", "sp_sub_compartment"]


def _strip(c: str) -> str:
    return _STRIP.format(c=c)


def _p2_sql() -> str:
    side = {t: _SQL_P2_SIDE.format(t_code=_strip("code"), texts=", ".join(f"{_strip(c)} as {c}" for c in _P2_TEXTS), table=t) for t in ("cf_flow_join", "cf_flow_join_copy")}
    keys = "a.run_id = b.run_id and a.method_slug = b.method_slug and a.code = b.code"
    parts = [f"select a.run_id, a.method_slug, a.code, '{c}' as field_name from a join b on {keys} where a.{c} is distinct from b.{c}" for c in [*_P2_TEXTS, "categories"]]
    for c in ("sp_cf", "ef_cf"):
        parts.append(f"select a.run_id, a.method_slug, a.code, '{c}' from a join b on {keys} where (a.{c} is null) <> (b.{c} is null) or abs(a.{c} - b.{c}) > 1e-6 * greatest(abs(a.{c}), abs(b.{c}))")
    parts.append(f"select a.run_id, a.method_slug, a.code, 'missing_in_copy' from a where not exists (select 1 from b where {keys})")
    parts.append(f"select b.run_id, b.method_slug, b.code, 'missing_in_join' from b where not exists (select 1 from a where {keys})")
    return f"with a as ({side['cf_flow_join']}), b as ({side['cf_flow_join_copy']}) select distinct * from (" + " union all ".join(parts) + ")"


_P6_SQL = f"""
with refs as (
  select 'mapping' as table_name, mapping_id as row_id, lower({_strip('target_code')}) as code, lower({_strip('target_db')}) as db, recorded_at from mapping where not coalesce(is_unmatchable, false)
  union all select 'flow_records', record_id, lower({_strip('target_code')}), lower({_strip('target_db')}), recorded_at from flow_records),
cat as (select lower({_strip('code')}) as code, lower({_strip('db')}) as db, added_at from biosphere_catalog),
gone as (select lower({_strip('code')}) as code, min(deleted_at) as at from deletion where code is not null group by 1),
hit as (select r.*, (select min(c.added_at) from cat c where c.code = r.code and (r.db is null or r.db = c.db)) as added, (select g.at from gone g where g.code = r.code) as gone_at from refs r where r.code is not null),
found as (
  select table_name, row_id, 'missing' as cause, recorded_at from hit where added is null
  union all select table_name, row_id, 'deleted', recorded_at from hit where gone_at <= recorded_at
  union all select table_name, row_id, 'later', recorded_at from hit where added > recorded_at)
select distinct table_name, row_id, cause, strftime(recorded_at, '%Y-%m') as ref_period from found"""



def _p1_sql() -> str:
    """The statement of the problem read plainly: every pair of a group is compared."""
    plain = lambda p: p.replace("(?iuU)", "(?i)").replace("(?U)", "").replace("'", "''")
    to = units.compose(units.EDGES, units.CANONICAL)
    exact = {s: u for u, ws in units.SPELLINGS.items() for s in ws}
    lower: dict[str, set] = {}
    for s, u in exact.items():
        lower.setdefault(s.lower(), set()).add(u)
    rows = exact | {s: next(iter(us)) for s, us in lower.items() if len(us) == 1 and s not in exact}
    values = ", ".join(f"('{s}', '{u}', '{to[u][0]}', {to[u][1].scale!r}::double)" for s, u in rows.items())
    doubtful = ", ".join(f"'{s}'" for s, us in lower.items() if len(us) > 1)
    holders = ", ".join(f"'{p}'" for p in units.PLACEHOLDERS)
    group = lambda c, p, g: f"nullif(regexp_extract({c}, '{plain(p)}', {g}), '')"

    def side(c: str, single: str, first: int, second: int) -> str:
        empty = f"lower(trim(regexp_replace(coalesce({c}, ''), '^\\s*\\[|\\]\\s*$', '', 'g'))) in ({holders})"
        return f"case when {empty} then coalesce({group('note', single, 1)}, {group('note', units.NOTE_SOURCE_FIRST, second)}, {group('note', units.NOTE_RESULT_FIRST, first)}) else {c} end"

    part = lambda c, g: f"regexp_extract({c}, '{plain(units._CELL_FORM)}', {g})"
    times = lambda x: f"case when {x} = '' then 1.0 else try_cast(replace(replace({x}, '10^', '1e'), ',', '.') as double) end"
    unit = lambda c: f"regexp_replace({part(c, 2)}, '\\s+', ' ', 'g') as {c}_base, {times(part(c, 1))} * {times(part(c, 3) + ' || ' + part(c, 4))} as {c}_times"
    key = lambda c: f"case when {c}_base in (select s from exact) then {c}_base when lower({c}_base) not in ({doubtful}) then lower({c}_base) end"
    return f"""
with sp(s, unit, kind, scale) as (values {values}), exact as (select s from (values {', '.join(f"('{s}')" for s in exact)}) v(s)),
cells as (
  select 'flowmap' as table_name, entry_id as id, provenance, conversion_factor as f, [package_id, trim(source_name), trim(target_name)] as names, {side('source_unit', units.NOTE_SOURCE, 2, 1)} as a, {side('target_unit', units.NOTE_TARGET, 1, 2)} as b from flowmap
  union all select 'unit_conversion', conv_id, provenance, multiplier, [], source_unit, target_unit from unit_conversion),
parsed as (select *, {unit('a')}, {unit('b')} from cells),
known as (
  select distinct p.table_name, p.id, p.provenance, p.names, case when p.table_name = 'flowmap' then x.kind else x.unit end as ka, case when p.table_name = 'flowmap' then y.kind else y.unit end as kb, f * (b_times * y.scale) / (a_times * x.scale) as v
  from parsed p join sp x on x.s = {key('p.a')} join sp y on y.s = {key('p.b')} where f is not null and not isnan(f))
select distinct m.table_name, m.id as id_a, n.id as id_b from known m join known n on m.table_name = n.table_name and m.names = n.names and m.ka = n.ka and m.kb = n.kb and m.id < n.id
where m.provenance is distinct from n.provenance and abs(m.v - n.v) > 0.01 * greatest(abs(m.v), abs(n.v))"""


ORACLE: dict[str, str] = {
    "p1_found": _p1_sql(),
    "p2_found": _p2_sql(),
    "p6_found": _P6_SQL,
    "p6_by_month": f"select table_name, ref_period, cause, count(*) as n from ({_P6_SQL}) group by 1, 2, 3",
}
