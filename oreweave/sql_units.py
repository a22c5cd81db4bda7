"""SQL that reads units, for comparing the unit operators with another engine."""

from __future__ import annotations

from oreweave.operators.units import MASS_UNITS, RATIO_UNITS, SCALES

_MASS = "|".join(p for p, _ in MASS_UNITS.values())
_SCALE = "|".join(p for p, _ in SCALES.values())
_UNIT = {"tonnage": f"(?:(?:{_SCALE})[ \\-]?)?(?:{_MASS})", "grade": "|".join(p for p, _ in RATIO_UNITS.values())}
_NUMBER = "(?:\\d{1,3}(?: \\d{3})+|\\d[\\d.,'’]*|[.,]\\d+)(?:[.,]\\d+)?(?:[eE][+\\-]?\\d+)?"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _factor(unit: str, field: str) -> str:
    cases = []
    if field == "grade":
        cases = [(f"^(?:{p})$", f) for p, f in RATIO_UNITS.values()]
    else:
        cases = [(f"^(?:{p})$", f) for p, f in MASS_UNITS.values()]
        cases += [(f"^(?:{sp})[ \\-]?(?:{p})$", f * sf) for sp, sf in SCALES.values() for p, f in MASS_UNITS.values()]
    return "CASE " + " ".join(f"WHEN regexp_matches({unit}, {_q(p)}) THEN {f!r}" for p, f in cases) + " END"


def _field(field: str) -> str:
    unit = _UNIT[field]
    cue = {"tonnage": "tonnages?|ore|weights?|quantit(?:y|ies)", "grade": "grades?|assays?|content|metal|values"}[field]
    text = f"regexp_replace(lower(d.remarks), {_q('(^|[^a-z0-9])(?:' + _UNIT['grade'] + ')([^a-z0-9]|$)')}, '\\1#\\2', 'g')" if field == "tonnage" else "lower(d.remarks)"
    remark = f"nullif(regexp_extract({text}, {_q(f'(?:{cue})[^.;#]*?(?: in | as |: ?| unit )({unit})(?:$|[ .;,)])')}, 1), '')"
    return f"""
SELECT statement_id, rid, '{field}' AS field, cell, cell_unit, number, number * coalesce({_factor('u_cell', field)}, {_factor('u_col', field)}, {_factor('u_rem', field)}, {_factor('u_src', field)}) AS value
FROM (
  SELECT statement_id, rid, cell, cell_unit, u_col, u_rem, u_src, u_cell,
    try_cast(replace(CASE WHEN regexp_matches(plain, '\\..*[.,]') THEN replace(plain, '.', '') ELSE plain END, ',', '.') AS DOUBLE) AS number
  FROM (
    SELECT *, regexp_replace(regexp_replace(num, '[ ''’]', '', 'g'), ',(\\d{{3}})\\b', '\\1', 'g') AS plain,
      nullif(regexp_extract(lower(substr(body, length(num) + 1)), {_q(f'^[ -]*({unit})(?:[^a-z0-9/%]|$)')}, 1), '') AS u_cell
    FROM (
      SELECT d.statement_id, trim(d.record_id, ' ') AS rid, d.{field} AS cell, d.{field}_unit AS cell_unit,
        lower(trim(d.{field}_unit, ' ')) AS u_col, {remark} AS u_rem, lower(s.{field}_unit) AS u_src,
        regexp_replace(regexp_replace(d.{field}, '\\s+', ' ', 'g'), '^ *(?:~|ca\\.|about|approx\\.|est\\.| )* *', '') AS body,
        regexp_extract(body, {_q('^(' + _NUMBER + ')')}, 1) AS num
      FROM deposit_statements d LEFT JOIN source_list s ON lower(trim(s.source, ' ')) = lower(trim(d.source, ' '))
      WHERE d.record_id IS NOT NULL)
    WHERE num <> ''))
WHERE number IS NOT NULL"""


STATED = f"stated AS ({_field('tonnage')} UNION ALL {_field('grade')})"
PAIRS = f"""
WITH {STATED}
SELECT a.statement_id AS statement_a, b.statement_id AS statement_b, a.field
FROM stated a JOIN stated b ON a.rid = b.rid AND a.field = b.field AND a.statement_id < b.statement_id
WHERE greatest(a.value, b.value) <= least(a.value, b.value) * 1.005 * (1 + 1e-12)
  AND NOT (a.cell IS NOT DISTINCT FROM b.cell AND a.cell_unit IS NOT DISTINCT FROM b.cell_unit)"""
