"""Log routing queries."""

from __future__ import annotations


from ..functions.levels import LEVEL_ORDINAL, LEVEL_VALUE
from ..operators import routing
from . import standins
from .catalog import register, table


def _routed(spark, sf_dir):
    msgs = standins.log_messages(table(spark, sf_dir, "events"))
    return routing.route_logs(msgs.select("event_id", "ts", "logger", "level", "message"))


def _sql_config() -> str:
    rows = []
    for r in routing.DEFAULT_ROUTES:
        lvl = LEVEL_ORDINAL[r.level] if r.level else "NULL"
        sinks = r.sinks or (None,)
        for s in sinks:
            rows.append(f"('{r.logger}', {lvl}, {str(r.additive).upper()}, {repr(s) if s else 'NULL'})")
    return ", ".join(rows)


_LEVEL_VALUE_CASE = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEVEL_VALUE.items())
_LEVEL_CASE = "CASE level " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEVEL_ORDINAL.items()) + " END"

# Oracle: the theta join of every event with all configured ancestors, the
# nearest level by arg_max over name length, the additive cut by the longest
# non-additive ancestor.
SQL_ROUTE = f"WITH msgs AS ({standins.sql_log_messages()})" + f""",
cfg(name, lvl, additive, sink) AS (VALUES {_sql_config()}),
anc AS (SELECT m.event_id, m.ts, m.logger, m.level, m.message, c.name, c.lvl, c.additive, c.sink
        FROM msgs m JOIN cfg c
          ON c.name = '' OR m.logger = c.name OR starts_with(m.logger, c.name || '.')),
eff AS (SELECT event_id, arg_max(lvl, length(name)) FILTER (WHERE lvl IS NOT NULL) AS eff_lvl,
               max(length(name)) FILTER (WHERE NOT additive) AS cut
        FROM anc GROUP BY event_id),
routed AS (
  SELECT DISTINCT a.event_id, a.ts, a.logger, a.level, a.message, a.sink
  FROM anc a JOIN eff e USING (event_id)
  WHERE a.sink IS NOT NULL AND length(a.name) >= COALESCE(e.cut, -1)
    AND {_LEVEL_CASE.replace('level', 'a.level', 1)} >= e.eff_lvl)"""


@register("log_route", "J2 F5 X11 S6", SQL_ROUTE + " SELECT event_id, logger, level, sink FROM routed")
def q_log_route(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "logger", "level", "sink")


SQL_LOG_JSON = f"""
SELECT event_id, sink,
       CAST(json_object('@timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00', '@version', '1',
                        'message', message, 'logger_name', logger, 'level', level,
                        'level_value', CASE level {_LEVEL_VALUE_CASE} END) AS VARCHAR) AS value
FROM routed"""


@register("log_to_json", "X2 S5", SQL_ROUTE + SQL_LOG_JSON)
def q_log_to_json(spark, sf_dir):
    r = _routed(spark, sf_dir)
    return routing.log_records(r.select("event_id", "sink", "ts", "message", "logger", "level"))
