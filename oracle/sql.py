"""DuckDB SQL oracles, written independently of the Spark code.

Each oracle is a chain of CTEs over the pre-registered ``events`` view:
the visits fixture, the daily home zip (aggregate + self-join arg-max, as the
reference writes it), the closed-form reference zip, the state snapshot
before ``SNAPSHOT_DAY`` and the recursive per-user fold.  ``build()`` returns
the dict used by ``__spark_entry__.oracle_sql``.
"""

from __future__ import annotations

from homeshift.config import FIRST_DAY, FIXTURE_THRESHOLDS as TH, LATE_DAY, RUN_AGE_LIMIT, SNAPSHOT_DAY, SNAPSHOT_AGE_LIMIT, WEEKEND_DAY

D = f"DATE '{SNAPSHOT_DAY.isoformat()}'"

VISITS = """visits AS (
  SELECT CAST(user_id AS VARCHAR) AS cookie, zipcode, tranche, d AS "date", CAST(sum(n) AS BIGINT) AS nb_hits
  FROM (SELECT user_id, d, 1 + k % 5 AS n,
          CASE WHEN h < 6 THEN 3 WHEN h < 9 THEN 0 WHEN h < 18 THEN 1 ELSE 2 END AS tranche,
          CASE WHEN k < 3 THEN '7500' WHEN k >= 90 THEN CAST(69001 + k AS VARCHAR)
               WHEN user_id % 4 = 0 AND d >= DATE '2024-01-13' THEN CAST(13001 + (user_id * 11) % 900 AS VARCHAR)
               ELSE CAST(75001 + (user_id * 37) % 900 AS VARCHAR) END AS zipcode
        FROM (SELECT user_id, CAST(ts AS DATE) AS d, hour(ts) AS h,
                CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
  GROUP BY ALL)"""

VD = """vd AS (SELECT DISTINCT TRY_CAST(cookie AS BIGINT) AS user_id, zipcode, nb_hits,
  TRY_CAST(tranche AS INTEGER) AS tranche, "date" AS day FROM visits)"""
VV = "vv AS (SELECT * FROM vd WHERE user_id IS NOT NULL AND length(zipcode) = 5)"
WE = "(isodow({d}) IN (6, 7))"
HR = f"hr AS (SELECT * FROM vv WHERE {WE.format(d='day')} OR tranche IN (2, 3))"
HITS = """hits AS (SELECT user_id, day, zipcode, CAST(sum(nb_hits) AS BIGINT) AS nb_page
  FROM hr GROUP BY user_id, day, zipcode)"""
MH = "mh AS (SELECT user_id, day, max(nb_page) AS max_page FROM hits GROUP BY user_id, day)"
DHZ = """dhz AS (SELECT h.user_id, max(h.zipcode) AS zipcode, h.day
  FROM hits h JOIN mh ON h.user_id = mh.user_id AND h.day = mh.day AND h.nb_page = mh.max_page
  GROUP BY h.user_id, h.day)"""

BASE = [VISITS, VD, VV, HR, HITS, MH, DHZ]


def w(ctes, select: str) -> str:
    rec = any(c.startswith("RECURSIVE ") for c in ctes)
    body = ",\n".join(c[len("RECURSIVE "):] if c.startswith("RECURSIVE ") else c for c in ctes)
    return ("WITH RECURSIVE " if rec else "WITH ") + body + "\n" + select


S, P = TH.min_days, TH.min_share
AGE_LIMIT = SNAPSHOT_AGE_LIMIT
WK = (TH.week_min_weekend, TH.week_min_weekday, TH.week_share_weekend, TH.week_share_weekday)


def we(d: str) -> str:
    return f"CASE WHEN isodow({d}) IN (6, 7) THEN 1 ELSE 0 END"


def wd(d: str) -> str:
    return f"CASE WHEN isodow({d}) IN (6, 7) THEN 0 ELSE 1 END"


def days(a: str, b: str) -> str:
    """Inclusive day count from b to a, as INTEGER."""
    return f"CAST(date_diff('day', {b}, {a}) + 1 AS INTEGER)"


def share(x: str, tot: str) -> str:
    return f"CASE WHEN {tot} = 0 THEN 0.0 ELSE {x} / ({tot} * 1.0) END"


def week_ok(x_we, x_sem, t_we, t_sem) -> str:
    a, b, c, d = WK
    return (f"({t_we} >= {a} AND {t_sem} >= {b} AND {share(x_we, t_we)} >= {c} "
            f"AND {share(x_sem, t_sem)} >= {d})")


def closed_form(src: str, p: str) -> list[str]:
    """Reference, routes, islands and pool without eviction over relation ``src``.

    Names are prefixed with ``p``.  Islands use the row-number difference
    (a different technique from the Spark side's lag + running sum).
    """
    return [
        f"""{p}ax AS (SELECT user_id, zipcode, day,
  min(day) OVER (PARTITION BY user_id) AS first_seen,
  count(*) OVER (PARTITION BY user_id, zipcode ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zip_days
  FROM {src})""",
        f"""{p}rz AS (SELECT user_id, arg_min(zipcode, day) AS reference_zip, min(day) AS ref_day FROM {p}ax
  WHERE zip_days >= {S} AND zip_days / ({days('day', 'first_seen')} * 1.0) >= {P} GROUP BY user_id)""",
        f"""{p}fa AS (SELECT a.user_id, min(a.day) AS first_away FROM {p}ax a JOIN {p}rz r ON a.user_id = r.user_id
  WHERE a.day > r.ref_day AND a.zipcode <> r.reference_zip GROUP BY a.user_id)""",
        f"""{p}ro AS (SELECT a.user_id, a.zipcode, a.day, r.reference_zip, r.ref_day,
  CASE WHEN r.ref_day IS NULL OR a.day <= r.ref_day THEN 'reference'
       WHEN f.first_away IS NULL OR a.day < f.first_away THEN 'home' ELSE 'mover' END AS route
  FROM {p}ax a LEFT JOIN {p}rz r ON a.user_id = r.user_id LEFT JOIN {p}fa f ON a.user_id = f.user_id)""",
        f"""{p}mg AS (SELECT user_id, zipcode, day, reference_zip,
  row_number() OVER (PARTITION BY user_id ORDER BY day)
  - row_number() OVER (PARTITION BY user_id, zipcode ORDER BY day) AS grp
  FROM {p}ro WHERE route = 'mover')""",
        f"""{p}mi AS (SELECT user_id, zipcode, day, reference_zip,
  min(day) OVER (PARTITION BY user_id, zipcode, grp) AS streak_start,
  CAST(sum({we('day')}) OVER (PARTITION BY user_id, zipcode, grp ORDER BY day) AS BIGINT) AS weekend_days,
  CAST(sum({wd('day')}) OVER (PARTITION BY user_id, zipcode, grp ORDER BY day) AS BIGINT) AS weekday_days
  FROM {p}mg)""",
        f"""{p}st AS (SELECT user_id, zipcode, streak_start, weekend_days, weekday_days,
  CAST({days('day', 'streak_start')} // 7 AS INTEGER) AS week_no
  FROM (SELECT *, max(day) OVER (PARTITION BY user_id) AS last_day FROM {p}mi) WHERE day = last_day)""",
        f"""{p}po AS (SELECT user_id, zipcode, confirmed_week, min(since) AS since FROM (
  SELECT user_id, zipcode, 0 AS confirmed_week, streak_start AS since FROM {p}mi
  UNION ALL
  SELECT user_id, zipcode, CAST({days('day', 'streak_start')} // 7 AS INTEGER), day FROM {p}mi
  WHERE {days('day', 'streak_start')} >= 7 AND {days('day', 'streak_start')} % 7 = 0
    AND zipcode <> reference_zip
    AND {week_ok('weekend_days', 'weekday_days', 'weekend_days', 'weekday_days')}
  ) GROUP BY user_id, zipcode, confirmed_week)""",
    ]


DL = f"(DATE '{SNAPSHOT_DAY.isoformat()}' - INTERVAL 1 DAY)::DATE"

SNAP = BASE + [f"bf AS (SELECT * FROM dhz WHERE day < {D})"] + closed_form("bf", "s_") + [
    f"td AS (SELECT user_id, zipcode FROM dhz WHERE day = {D})",
    "ref AS (SELECT user_id, reference_zip FROM s_rz)",
    f"""hist AS (SELECT user_id, zipcode, CAST(sum({we('day')}) AS BIGINT) AS weekend_days,
  CAST(sum({wd('day')}) AS BIGINT) AS weekday_days FROM s_ro WHERE route IN ('reference', 'home') GROUP BY ALL)""",
    f"""reg AS (SELECT user_id, max(day) AS last_seen, min(day) AS first_seen,
  coalesce({days(DL, 'max(CASE WHEN day < ' + DL + ' THEN day END)')}, 1) AS gap_days,
  {days(DL, 'min(day)')} AS tenure_days
  FROM s_ro WHERE route IN ('reference', 'home') GROUP BY user_id)""",
    "streak AS (SELECT * FROM s_st)",
    "pool AS (SELECT * FROM s_po)",
    """cmp AS (SELECT t.user_id, t.zipcode,
  CASE WHEN t.zipcode IS NOT DISTINCT FROM r.reference_zip THEN 1 ELSE 0 END AS matches_reference
  FROM td t JOIN ref r ON t.user_id = r.user_id)""",
    "nor AS (SELECT user_id, zipcode FROM td t WHERE NOT EXISTS (SELECT 1 FROM ref r WHERE r.user_id = t.user_id))",
    "pu AS (SELECT DISTINCT user_id FROM pool WHERE zipcode IS NOT NULL)",
    """rt AS (SELECT c.user_id, c.zipcode, c.matches_reference,
  CASE WHEN pu.user_id IS NOT NULL THEN 'mover' WHEN c.matches_reference = 1 THEN 'home' ELSE 'mover' END AS route
  FROM cmp c LEFT JOIN pu ON c.user_id = pu.user_id)""",
    "rfeed AS (SELECT user_id, zipcode FROM nor UNION ALL SELECT user_id, zipcode FROM rt WHERE route = 'home')",
    "mfeed AS (SELECT DISTINCT user_id, zipcode FROM rt WHERE route = 'mover')",
    f"""hist2 AS (SELECT user_id, zipcode, CAST(sum(weekend_days) AS BIGINT) AS weekend_days,
  CAST(sum(weekday_days) AS BIGINT) AS weekday_days FROM (
  SELECT user_id, zipcode, weekend_days, weekday_days FROM hist UNION ALL
  SELECT user_id, zipcode, {we(D)}, {wd(D)} FROM rfeed) GROUP BY user_id, zipcode)""",
    f"""reg2 AS (SELECT user_id, max(last_seen) AS last_seen, min(first_seen) AS first_seen,
  max(gap_days) AS gap_days, max(tenure_days) AS tenure_days FROM (
  SELECT user_id, last_seen, first_seen, {days(D, 'last_seen')} AS gap_days, {days(D, 'first_seen')} AS tenure_days FROM reg
  UNION SELECT user_id, {D}, {D}, 1, 1 FROM rfeed) GROUP BY user_id)""",
    f"""sA AS (SELECT f.user_id, f.zipcode, {D} AS streak_start, CAST({we(D)} AS BIGINT) AS weekend_days,
  CAST({wd(D)} AS BIGINT) AS weekday_days, 0 AS week_no
  FROM mfeed f LEFT JOIN streak s ON f.user_id = s.user_id WHERE s.user_id IS NULL)""",
    f"""sB AS (SELECT s.user_id, s.zipcode, s.streak_start, s.weekend_days + {we(D)} AS weekend_days,
  s.weekday_days + {wd(D)} AS weekday_days, CAST({days(D, 's.streak_start')} // 7 AS INTEGER) AS week_no
  FROM mfeed f JOIN streak s ON f.user_id = s.user_id AND f.zipcode = s.zipcode)""",
    f"""sC AS (SELECT f.user_id, f.zipcode, {D} AS streak_start, CAST({we(D)} AS BIGINT) AS weekend_days,
  CAST({wd(D)} AS BIGINT) AS weekday_days, 0 AS week_no
  FROM mfeed f JOIN streak s ON f.user_id = s.user_id AND f.zipcode <> s.zipcode)""",
    """sD AS (SELECT s.* FROM streak s WHERE NOT EXISTS (SELECT 1 FROM mfeed f WHERE f.user_id = s.user_id))""",
    """st2 AS (SELECT user_id, zipcode, min(streak_start) AS streak_start, CAST(sum(weekend_days) AS BIGINT) AS weekend_days,
  CAST(sum(weekday_days) AS BIGINT) AS weekday_days, max(week_no) AS week_no FROM (
  SELECT * FROM sA UNION ALL SELECT * FROM sC UNION ALL SELECT * FROM sB UNION ALL SELECT * FROM sD)
  GROUP BY user_id, zipcode)""",
    f"""po2 AS (SELECT user_id, zipcode, confirmed_week, min(since) AS since FROM (
  SELECT * FROM pool UNION ALL SELECT user_id, zipcode, 0, {D} FROM sA UNION ALL SELECT user_id, zipcode, 0, {D} FROM sC)
  GROUP BY user_id, zipcode, confirmed_week)""",
    f"st2a AS (SELECT *, {days(D, 'streak_start')} AS age FROM st2)",
    "ann AS (SELECT * FROM st2a WHERE age >= 7 AND age % 7 = 0 AND week_no = age // 7)",
    """tots AS (SELECT user_id, week_no, CAST(sum(weekend_days) AS BIGINT) AS total_weekend,
  CAST(sum(weekday_days) AS BIGINT) AS total_weekday FROM st2 GROUP BY user_id, week_no)""",
    f"""conf AS (SELECT a.user_id, max(a.zipcode) AS zipcode, a.week_no FROM ann a
  JOIN (SELECT user_id, week_no, total_weekend AS tw, total_weekday AS ts FROM tots) t ON a.user_id = t.user_id AND a.week_no = t.week_no
  WHERE {week_ok('a.weekend_days', 'a.weekday_days', 't.tw', 't.ts')} GROUP BY a.user_id, a.week_no)""",
    """chome AS (SELECT DISTINCT c.user_id, c.week_no FROM conf c JOIN ref r ON c.user_id = r.user_id
  AND c.zipcode = r.reference_zip)""",
    f"""celse AS (SELECT c.user_id, c.zipcode, c.week_no AS confirmed_week, {D} AS since FROM conf c
  JOIN ref r ON c.user_id = r.user_id WHERE c.zipcode <> r.reference_zip)""",
    f"""page AS (SELECT user_id, min(since) AS date_min, max(since) AS date_max,
  {days(D, 'min(since)')} AS presence_days FROM po2 GROUP BY user_id)""",
    f"""aret AS (SELECT h.user_id, h.week_no AS week, p.date_min, p.date_max, {D} AS day, p.presence_days
  FROM chome h JOIN page p ON h.user_id = p.user_id WHERE p.presence_days <= {TH.return_limit})""",
    f"""aold AS (SELECT o.user_id, o.zipcode, o.confirmed_week, o.since, p.date_min, p.date_max, {D} AS day,
  p.presence_days FROM po2 o JOIN page p ON o.user_id = p.user_id WHERE p.presence_days > {AGE_LIMIT})""",
    "gone AS (SELECT user_id FROM aret UNION SELECT user_id FROM aold)",
]


def snap_of(day) -> list[str]:
    """The snapshot's relations for another day."""
    return [c.replace(D, f"DATE '{day.isoformat()}'") for c in SNAP]


def pool_of(source: str, without: str) -> str:
    return f"""SELECT user_id, zipcode, confirmed_week, min(since) AS since FROM (
  SELECT * FROM {source} UNION ALL SELECT * FROM celse) WHERE user_id NOT IN (SELECT user_id FROM {without})
  GROUP BY user_id, zipcode, confirmed_week"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["visits_from_events"] = w([VISITS], "SELECT * FROM visits")
    q["daily_home_zip"] = w(BASE, "SELECT user_id, zipcode, day FROM dhz")
    we_day = WE.format(d="day")
    dz = lambda cond: w([VISITS, VD, VV, f"hr AS (SELECT * FROM vv WHERE {cond})", HITS, MH, DHZ],
                        "SELECT user_id, zipcode, day FROM dhz")
    q["daily_home_zip_weekend"] = dz(we_day)
    q["daily_home_zip_weekday"] = dz(f"NOT {we_day} AND tranche IN (2, 3)")
    q["scan_visits_distinct"] = w([VISITS, VD], "SELECT * FROM vd")
    q["hits_per_user_zip"] = w(BASE, "SELECT * FROM hits")
    q["max_hits_per_user"] = w(BASE, "SELECT * FROM mh")
    q["argmax_zip"] = w(BASE, """SELECT user_id, day, max(zipcode) AS zipcode, max(nb_page) AS nb_page
  FROM hits WHERE (user_id, day, nb_page) IN (SELECT user_id, day, max_page FROM mh) GROUP BY user_id, day""")
    q["filter_valid_zip"] = w([VISITS, VD, VV], "SELECT * FROM vv")
    lab = "CASE WHEN tranche IN (2, 3) THEN 'home' ELSE 'middayOrWork' END"
    q["label_home_hours"] = w([VISITS, VD, VV], f"SELECT *, {lab} AS hours FROM vv")
    q["filter_home_hours"] = w([VISITS, VD, VV], f"SELECT * FROM vv WHERE {lab} = 'home'")

    full = BASE + closed_form("dhz", "f_")
    q["reference_zip"] = w(full, "SELECT user_id, reference_zip, ref_day FROM f_rz")
    q["mover_streak"] = w(full, "SELECT * FROM f_st")
    q["mover_pool"] = w(full, "SELECT * FROM f_po")

    q["scan_day_partition"] = w(BASE, f"SELECT user_id, zipcode, day FROM dhz WHERE day = {D}")
    q["compare_with_reference"] = w(SNAP, "SELECT * FROM cmp")
    q["no_reference_yet"] = w(SNAP, "SELECT * FROM nor")
    q["already_in_pool"] = w(SNAP, "SELECT * FROM cmp WHERE user_id IN (SELECT user_id FROM pu)")
    q["not_in_pool"] = w(SNAP, "SELECT * FROM cmp WHERE user_id NOT IN (SELECT user_id FROM pu)")
    q["route_day"] = w(SNAP, "SELECT * FROM rt")
    q["tag_constants"] = w(SNAP, f"SELECT user_id, zipcode, CAST({we(D)} AS BIGINT) AS weekend_days, "
                                 f"CAST({wd(D)} AS BIGINT) AS weekday_days FROM rfeed")
    q["history_update"] = w(SNAP, "SELECT * FROM hist2")
    q["registry_update"] = w(SNAP, "SELECT * FROM reg2")
    q["derive_total_days"] = w(SNAP, "SELECT *, weekend_days + weekday_days AS total_day_zip FROM hist2")
    q["history_with_totals"] = w(SNAP, """SELECT h.*, h.weekend_days + h.weekday_days AS total_day_zip,
  t.total_weekend, t.total_weekday FROM hist2 h JOIN (SELECT user_id, CAST(sum(weekend_days) AS BIGINT) AS total_weekend,
  CAST(sum(weekday_days) AS BIGINT) AS total_weekday FROM hist2 GROUP BY user_id) t ON h.user_id = t.user_id""")
    q["reference_candidates"] = w(SNAP, f"""SELECT h.user_id, h.zipcode AS reference_zip FROM hist2 h
  JOIN reg2 r ON h.user_id = r.user_id WHERE h.weekend_days + h.weekday_days >= {S}
  AND (h.weekend_days + h.weekday_days) / (r.tenure_days * 1.0) >= {P}""")
    q["streak_new"] = w(SNAP, "SELECT * FROM sA")
    q["streak_continued"] = w(SNAP, "SELECT * FROM sB")
    q["streak_changed"] = w(SNAP, "SELECT * FROM sC")
    q["streak_unseen"] = w(SNAP, "SELECT * FROM sD")
    q["streak_other_zip"] = w(SNAP, """SELECT s.*, f.zipcode AS new_zip FROM streak s
  JOIN mfeed f ON f.user_id = s.user_id AND f.zipcode <> s.zipcode""")
    q["streak_merge"] = w(SNAP, "SELECT * FROM st2")
    q["pool_merge"] = w(SNAP, "SELECT * FROM po2")
    q["max_streak_age"] = w(SNAP, "SELECT max(age) AS max_age, CAST(max(age) // 7 AS INTEGER) AS rounds FROM st2a")
    q["anniversary_rows"] = w(SNAP, "SELECT * FROM ann")
    q["week_shares"] = w(SNAP, f"""SELECT s.*, t.total_weekend, t.total_weekday,
  {share('s.weekend_days', 't.total_weekend')} AS share_weekend, {share('s.weekday_days', 't.total_weekday')} AS share_weekday
  FROM st2 s JOIN tots t ON s.user_id = t.user_id AND s.week_no = t.week_no""")
    q["week_confirmed"] = w(SNAP, "SELECT user_id, zipcode, week_no FROM conf")
    q["confirmed_home"] = w(SNAP, "SELECT * FROM chome")
    q["confirmed_elsewhere"] = w(SNAP, "SELECT * FROM celse")
    q["pool_age"] = w(SNAP, "SELECT * FROM page")
    q["audit_returned_home"] = w(SNAP, "SELECT * FROM aret")
    q["audit_aged_out"] = w(SNAP, "SELECT * FROM aold")
    q["pool_after_eviction"] = w(SNAP, pool_of("po2", "gone"))
    q["pool_without_confirmed_home"] = w(SNAP, pool_of("po2", "chome"))
    q["streak_without_confirmed_home"] = w(SNAP, "SELECT * FROM st2 WHERE user_id NOT IN (SELECT user_id FROM chome)")
    first, weekend, late = (snap_of(d) for d in (FIRST_DAY, WEEKEND_DAY, LATE_DAY))
    q["no_reference_yet_first"] = w(first, "SELECT * FROM nor")
    q["streak_new_weekend"] = w(weekend, "SELECT * FROM sA")
    q["streak_merge_weekend"] = w(weekend, "SELECT * FROM st2")
    q["history_update_weekend"] = w(weekend, "SELECT * FROM hist2")
    q["confirmed_home_late"] = w(late, "SELECT * FROM chome")
    q["audit_returned_home_late"] = w(late, "SELECT * FROM aret")
    q["pool_after_eviction_late"] = w(late, pool_of("po2", "gone"))
    q["streak_after_eviction_late"] = w(late, "SELECT * FROM st2 WHERE user_id NOT IN (SELECT user_id FROM gone)")
    q["streak_after_eviction"] = w(SNAP, "SELECT * FROM st2 WHERE user_id NOT IN (SELECT user_id FROM gone)")
    V = [VISITS]
    q["scan_visits_all"] = w(V, 'SELECT cookie, zipcode, tranche, nb_hits, "date" FROM visits')
    q["scan_catalog_table"] = w(V, "SELECT * FROM visits")
    q["named_relation_sql"] = w(V, """SELECT zipcode, count(DISTINCT cookie) AS users, CAST(sum(nb_hits) AS BIGINT) AS hits
  FROM visits GROUP BY zipcode""")
    q["project_cast"] = w(V, """SELECT TRY_CAST(cookie AS BIGINT) AS user_id, zipcode, nb_hits,
  TRY_CAST(tranche AS INTEGER) AS tranche, "date" FROM visits""")
    q["load_days_tagged"] = w(V, """SELECT *, strftime("date", '%Y%m%d') AS day1 FROM visits""")
    q["date_bounds"] = w(V, """SELECT min("date") AS date_min, max("date") AS date_max FROM visits""")
    q["distinct_projection"] = w(BASE, "SELECT DISTINCT user_id, zipcode FROM dhz")
    q["filter_like"] = w(V, "SELECT DISTINCT zipcode FROM visits WHERE zipcode LIKE '%7500%'")
    q["safe_share"] = w(BASE, f"""SELECT h.user_id, h.day, h.zipcode, h.nb_page, {share('h.nb_page', 't.total')} AS share
  FROM hits h JOIN (SELECT user_id, day, sum(nb_page) AS total FROM hits GROUP BY user_id, day) t
  ON h.user_id = t.user_id AND h.day = t.day""")
    cal = lambda pad: f"""SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(
  CAST(min("date") - {pad} AS TIMESTAMP), CAST(max("date") + {pad} AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM visits)"""
    q["calendar_range"] = w(V, f"""SELECT day, strftime(day, '%Y-%m-%d') AS day_dashed, strftime(day, '%Y%m%d') AS day_compact
  FROM ({cal(0)})""")
    q["day_exists"] = w(V, f"""SELECT day, day IN (SELECT "date" FROM visits) AS exists FROM ({cal(2)})""")
    lb = """lb AS (SELECT o AS off, CAST((SELECT max("date") FROM visits) + 1 - CAST(o AS INTEGER) AS DATE) AS day
  FROM range(3, 50) t(o))"""
    q["available_days"] = w(V + [lb], """SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS pos,
  strftime(day, '%Y%m%d') AS day_compact FROM (
  SELECT * FROM lb WHERE day IN (SELECT "date" FROM visits))""")
    q["available_days_capped"] = w(V + [lb], """SELECT CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS pos,
  strftime(day, '%Y%m%d') AS day_compact FROM (
  SELECT * FROM lb WHERE day IN (SELECT "date" FROM visits) ORDER BY off LIMIT 10)""")
    q["scan_weekend_days"] = w(BASE, f"SELECT user_id, zipcode, day FROM dhz WHERE {WE.format(d='day')}")
    q["missing_days"] = w(V + [lb], """SELECT CAST(row_number() OVER (ORDER BY off) AS INTEGER) AS pos,
  strftime(day, '%Y%m%d') AS day_compact FROM lb WHERE day NOT IN (SELECT "date" FROM visits)""")
    dd = 'dd AS (SELECT DISTINCT "date" AS day FROM visits)'
    q["date_parts"] = w(V + [dd], """SELECT strftime(day, '%Y-%m-%d') AS dashed, strftime(day, '%Y%m%d') AS compact,
  CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day_of_month,
  CAST(year(day) AS INTEGER) AS c_year, CAST(month(day) AS INTEGER) AS c_month,
  CAST(day(day) AS INTEGER) AS c_day_of_month FROM dd""")
    q["weekend_label"] = w(V + [dd], f"SELECT day, CASE WHEN {WE.format(d='day')} THEN 'we' ELSE 'sem' END AS label FROM dd")
    q["weekday_name"] = w(V + [dd], "SELECT day, dayname(day) AS day_name FROM dd")
    q["format_day"] = w(V + [dd], """SELECT strftime(day, '%Y%m%d') AS day_compact, strftime(day, '%Y-%m-%d') AS day_dashed,
  strftime(day, '%Y/%m/%d') AS day_slashed FROM dd""")
    q["day_before"] = w(V + [dd], """SELECT strftime(day, '%Y%m%d') AS day_compact, strftime(day - 1, '%Y%m%d') AS day_before_1,
  strftime(day - 7, '%Y%m%d') AS day_before_7 FROM dd""")
    spans = "sp AS (SELECT user_id, min(day) AS first_day, max(day) AS last_day FROM dhz GROUP BY user_id)"
    q["inclusive_day_diff"] = w(BASE + [spans], f"SELECT *, {days('last_day', 'first_day')} AS span_days FROM sp")
    q["elapsed_weeks"] = w(BASE + [spans], f"SELECT user_id, CAST({days('last_day', 'first_day')} // 7 AS INTEGER) AS weeks FROM sp")
    q["zip_equal_flag"] = w(full, """SELECT d.user_id, d.day, d.zipcode,
  CASE WHEN d.zipcode IS NOT DISTINCT FROM r.reference_zip THEN 1 ELSE 0 END AS matches_reference
  FROM dhz d JOIN f_rz r ON d.user_id = r.user_id""")
    q["sink_roundtrip"] = q["daily_home_zip"]
    q["sink_append"] = q["daily_home_zip"]
    q["sink_create_if_absent"] = q["daily_home_zip_weekend"]
    q["sink_overwrite"] = q["daily_home_zip"]
    q["sink_insert_by_position"] = q["reference_zip"]
    q["split_by_day"] = w(V, "SELECT * FROM visits")
    q["stream_daily_home_zip"] = w(BASE, "SELECT user_id, zipcode, day FROM dhz")
    q.update(fold_oracles())
    return q


# ------------------------------------------------------------------ the fold
def fold_ctes(l1: int = TH.return_limit, l2: int = TH.age_limit) -> list[str]:
    """Recursive per-user fold in SQL: one recursion step per sighting after the reference day.

    Every step carries the state (streak zip/start/counters/week, first pool
    date, eviction epoch) and at most one emitted pool row, tagged with the
    epoch it was emitted in; rows of older epochs are dropped at the end.
    """
    ok = week_ok("q_we", "q_sem", "q_we", "q_sem")
    step = f"""SELECT f.user_id, s.n, s.zipcode, s.day, s.rz, s.wk, f.s_zip, f.s_start, f.s_we, f.s_sem, f.s_wk,
      f.pfirst, f.epoch, f.pfirst IS NOT NULL AND date_diff('day', f.pfirst, s.day) > {l2} AS evict0
    FROM fo f JOIN sg s ON s.user_id = f.user_id AND s.n = f.n + 1"""
    p1 = f"""SELECT user_id, n, zipcode, day, rz, wk, evict0,
      CASE WHEN evict0 THEN CAST(pfirst + {l2} AS DATE) END AS ev0_day,
      CASE WHEN evict0 THEN NULL ELSE s_zip END AS p_zip,
      CASE WHEN evict0 THEN NULL ELSE s_start END AS p_start,
      CASE WHEN evict0 THEN 0 ELSE s_we END AS p_we,
      CASE WHEN evict0 THEN 0 ELSE s_sem END AS p_sem,
      CASE WHEN evict0 THEN 0 ELSE s_wk END AS p_wk,
      CASE WHEN evict0 THEN NULL ELSE pfirst END AS p_first,
      epoch + CASE WHEN evict0 THEN 1 ELSE 0 END AS p_epoch
    FROM ({step})"""
    p2 = f"SELECT *, p_first IS NULL AND zipcode = rz AS home FROM ({p1})"
    p3 = f"""SELECT *, NOT home AND (p_zip IS NULL OR p_zip <> zipcode) AS new_streak,
      NOT home AND p_zip = zipcode AS cont FROM ({p2})"""
    p4 = f"""SELECT *,
      CASE WHEN new_streak THEN zipcode ELSE p_zip END AS q_zip,
      CASE WHEN new_streak THEN day ELSE p_start END AS q_start,
      CASE WHEN new_streak THEN wk WHEN cont THEN p_we + wk ELSE p_we END AS q_we,
      CASE WHEN new_streak THEN 1 - wk WHEN cont THEN p_sem + 1 - wk ELSE p_sem END AS q_sem,
      CASE WHEN NOT home AND p_first IS NULL THEN day ELSE p_first END AS q_first
    FROM ({p3})"""
    p5 = f"""SELECT *, CAST(date_diff('day', q_start, day) + 1 AS INTEGER) AS age,
      CAST(date_diff('day', q_first, day) + 1 AS INTEGER) AS presence FROM ({p4})"""
    p6 = f"""SELECT *, CASE WHEN new_streak THEN 0 WHEN cont THEN age // 7 ELSE p_wk END AS q_wk,
      cont AND age >= 7 AND age % 7 = 0 AND {ok} AS conf FROM ({p5})"""
    p7 = f"""SELECT *, conf AND zipcode = rz AND presence <= {l1} AS returned,
      q_first IS NOT NULL AND presence > {l2} AS aged FROM ({p6})"""
    p8 = f"SELECT *, returned OR aged AS gone FROM ({p7})"
    rec = f"""SELECT user_id, n,
      CASE WHEN gone THEN NULL ELSE q_zip END, CASE WHEN gone THEN NULL ELSE q_start END,
      CASE WHEN gone THEN 0 ELSE q_we END, CASE WHEN gone THEN 0 ELSE q_sem END,
      CASE WHEN gone THEN 0 ELSE q_wk END,
      CASE WHEN gone THEN NULL ELSE q_first END, p_epoch + CASE WHEN gone THEN 1 ELSE 0 END,
      day, home,
      CASE WHEN new_streak THEN zipcode WHEN conf AND zipcode <> rz THEN zipcode END,
      CAST(CASE WHEN new_streak THEN 0 WHEN conf AND zipcode <> rz THEN age // 7 END AS INTEGER),
      CASE WHEN new_streak OR (conf AND zipcode <> rz) THEN day END,
      p_epoch,
      CASE WHEN returned OR aged THEN day WHEN evict0 THEN ev0_day END,
      CASE WHEN returned AND aged THEN 'both' WHEN returned THEN 'returned' WHEN aged THEN 'aged' WHEN evict0 THEN 'aged' END,
      CAST(CASE WHEN returned OR aged THEN presence WHEN evict0 THEN {l2 + 1} END AS INTEGER)
    FROM ({p8})"""
    return BASE + closed_form("dhz", "f_") + [
        "hz AS (SELECT max(day) AS h FROM dhz)",
        f"""sg AS (SELECT d.user_id, d.zipcode, d.day, r.reference_zip AS rz, {we('d.day')} AS wk,
  row_number() OVER (PARTITION BY d.user_id ORDER BY d.day) AS n
  FROM dhz d JOIN f_rz r ON d.user_id = r.user_id WHERE d.day > r.ref_day)""",
        f"""RECURSIVE fo(user_id, n, s_zip, s_start, s_we, s_sem, s_wk, pfirst, epoch,
             day, home, e_zip, e_week, e_day, e_epoch, ev_day, ev_reason, ev_presence) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DATE), 0, 0, 0, CAST(NULL AS DATE), 0,
         CAST(NULL AS DATE), FALSE, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS DATE), 0,
         CAST(NULL AS DATE), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER)
  FROM sg
  UNION ALL
  {rec})""",
        """fl AS (SELECT f.*, hz.h FROM fo f JOIN (SELECT user_id, max(n) AS mn FROM fo GROUP BY user_id) m
  ON f.user_id = m.user_id AND f.n = m.mn CROSS JOIN hz)""",
        f"""fe AS (SELECT user_id, s_zip, s_start, s_we, s_sem, s_wk, pfirst, h,
  pfirst IS NOT NULL AND date_diff('day', pfirst, h) + 1 > {l2} AS hgone,
  epoch + CASE WHEN pfirst IS NOT NULL AND date_diff('day', pfirst, h) + 1 > {l2} THEN 1 ELSE 0 END AS final_epoch
  FROM fl)""",
        """fpool AS (SELECT o.user_id, o.e_zip AS zipcode, o.e_week AS confirmed_week, min(o.e_day) AS since
  FROM fo o JOIN fe ON o.user_id = fe.user_id AND o.e_epoch = fe.final_epoch
  WHERE o.e_zip IS NOT NULL GROUP BY o.user_id, o.e_zip, o.e_week)""",
        """fstreak AS (SELECT user_id, s_zip AS zipcode, s_start AS streak_start, CAST(s_we AS BIGINT) AS weekend_days,
  CAST(s_sem AS BIGINT) AS weekday_days, CAST(s_wk AS INTEGER) AS week_no
  FROM fe WHERE s_zip IS NOT NULL AND NOT hgone)""",
        f"""fevict AS (SELECT user_id, ev_day AS day, ev_reason AS reason, ev_presence AS presence_days
  FROM fo WHERE ev_day IS NOT NULL AND ev_reason <> 'both'
  UNION ALL SELECT user_id, ev_day, unnest(['returned', 'aged']), ev_presence FROM fo WHERE ev_reason = 'both'
  UNION ALL SELECT user_id, CAST(pfirst + {l2} AS DATE), 'aged', {l2 + 1} FROM fe WHERE hgone)""",
        """ffeed AS (SELECT user_id, zipcode, day FROM f_ro WHERE route = 'reference'
  UNION ALL SELECT s.user_id, s.zipcode, s.day FROM fo f JOIN sg s ON f.user_id = s.user_id AND f.n = s.n WHERE f.home)""",
        f"""fhist AS (SELECT user_id, zipcode, CAST(sum({we('day')}) AS BIGINT) AS weekend_days,
  CAST(sum({wd('day')}) AS BIGINT) AS weekday_days FROM ffeed GROUP BY user_id, zipcode)""",
        f"""freg AS (SELECT user_id, max(day) AS last_seen, min(day) AS first_seen,
  coalesce({days('(SELECT h FROM hz)', 'max(CASE WHEN day < (SELECT h FROM hz) THEN day END)')}, 1) AS gap_days,
  {days('(SELECT h FROM hz)', 'min(day)')} AS tenure_days FROM ffeed GROUP BY user_id)""",
        """fhome AS (SELECT DISTINCT p.user_id FROM fpool p JOIN f_rz r ON p.user_id = r.user_id
  AND p.zipcode = r.reference_zip)""",
        "fpot AS (SELECT * FROM fpool WHERE user_id NOT IN (SELECT user_id FROM fhome))",
        """fmoves AS (SELECT b.user_id, r.reference_zip AS old_zip, b.zipcode AS new_zip,
  (SELECT min(since) FROM fpot p WHERE p.user_id = b.user_id AND p.zipcode = b.zipcode) AS moved_on
  FROM (SELECT user_id, zipcode, row_number() OVER (PARTITION BY user_id
          ORDER BY confirmed_week DESC, since DESC, zipcode DESC) AS rk
        FROM fpot WHERE confirmed_week >= 1) b
  JOIN f_rz r ON b.user_id = r.user_id WHERE b.rk = 1)""",
    ]


def fold_oracles() -> dict[str, str]:
    F = fold_ctes()
    L = fold_ctes(l2=RUN_AGE_LIMIT)
    return {
        "evictions_aged": w(L, "SELECT * FROM fevict"),
        "mover_pool_aged": w(L, "SELECT * FROM fpool"),
        "mover_streak_aged": w(L, "SELECT * FROM fstreak"),
        "stream_movers_aged": w(L, "SELECT * FROM fpool"),
        "stream_evictions": w(L, "SELECT * FROM fevict"),
        "daily_state_evictions": w(L, "SELECT * FROM fevict WHERE day > (SELECT h - 3 FROM hz)"),
        "stream_late_corrected": w(F, "SELECT * FROM fpool"),
        "daily_state_pool": w(F, "SELECT * FROM fpool"),
        "daily_state_streak": w(L, "SELECT * FROM fstreak"),
        "daily_state_registry": w(F, "SELECT * FROM freg"),
        "mover_pool_final": w(F, "SELECT * FROM fpool"),
        "mover_streak_final": w(F, "SELECT * FROM fstreak"),
        "reference_history": w(F, "SELECT * FROM fhist"),
        "evictions": w(F, "SELECT * FROM fevict"),
        "home_seen_in_pool": w(F, "SELECT * FROM fhome"),
        "user_registry": w(F, "SELECT * FROM freg"),
        "scan_state_distinct": w(F, "SELECT DISTINCT user_id, zipcode FROM ffeed"),
        "run_metrics": w(F, """SELECT 'visits_rows' AS metric, count(*) AS value FROM visits
  UNION ALL SELECT 'daily_home_zip_rows', count(*) FROM dhz
  UNION ALL SELECT 'users_with_reference', count(*) FROM f_rz
  UNION ALL SELECT 'reference_history_rows', count(*) FROM fhist
  UNION ALL SELECT 'mover_streak_rows', count(*) FROM fstreak
  UNION ALL SELECT 'mover_pool_rows', count(*) FROM fpool
  UNION ALL SELECT 'returned_home_evictions', count(*) FROM fevict WHERE reason = 'returned'
  UNION ALL SELECT 'potential_mover_users', count(DISTINCT user_id) FROM fpot
  UNION ALL SELECT 'potential_mover_rows', count(*) FROM fpot
  UNION ALL SELECT 'moves_rows', count(*) FROM fmoves"""),
        "potential_movers": w(F, "SELECT * FROM fpot"),
        "stream_movers": w(F, "SELECT * FROM fpool"),
        "moves": w(F, "SELECT * FROM fmoves"),
        "pool_profile": w(F, """SELECT user_id, count(DISTINCT confirmed_week) AS n_states,
  count(DISTINCT since) AS n_dates, count(CASE WHEN confirmed_week >= 1 THEN zipcode END) AS n_confirmed_zips
  FROM fpool GROUP BY user_id"""),
    }
