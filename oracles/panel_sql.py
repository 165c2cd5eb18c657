"""DuckDB SQL for the registered queries, written as a set of named subqueries.

Each query text takes along only the subqueries that it names, directly or through others.
"""

from __future__ import annotations

import re

from oracles.hash_sql import chance, choose, json_text, permutation_step, pick, pick_place, shuffled, take, text_list, u, wide
from rosterloom.functions import pools
from rosterloom.functions.text import latin_word
from rosterloom.plans.testbed import CHAIN, SAMPLE
from rosterloom.sources.schema import ARRAY_COLUMNS, PANEL, PANEL_COLUMNS

MONTHS = 6
N = "(SELECT count(*) FROM customer)"
LEAVE_QUOTA = f"round_even({N} * 0.015::DOUBLE, 0)::BIGINT"
CHANGE_QUOTA = f"round_even({N} * 0.02::DOUBLE, 0)::BIGINT"
RANGE = 2**62
FEMALE_SURNAMES = [s + "а" for s in pools.SURNAMES]


def _case(key: str, values) -> str:
    lit = lambda v: str(v).upper() if isinstance(v, bool) else str(v)
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


PARTS: dict[str, str] = {}

PARTS["spine"] = f"""
    SELECT m::INTEGER AS m, last_day(DATE '2025-10-31' + to_months(m::INTEGER))::DATE AS d
    FROM range({MONTHS}) t(m)"""
PARTS["quarters"] = """
    SELECT m, d, max(CASE WHEN m > 0 AND month(d) IN (3, 6, 9, 12) THEN m END) OVER (ORDER BY m) AS lastq FROM spine"""
PARTS["slots"] = f"""
    SELECT k, row_number() OVER (ORDER BY su, k) - 1 AS slot
    FROM (SELECT c_custkey AS k, {u('slot', 'c_custkey')} AS su FROM customer)"""
PARTS["leaving"] = f"""
    SELECT k, m, row_number() OVER (PARTITION BY m ORDER BY lu, k) AS rn
    FROM (SELECT k, m, {u('leave', 'k', 'm')} AS lu FROM slots, spine WHERE m > 0)"""
PARTS["hired"] = f"""
    SELECT k, m, 10000001 + {N} + (m - 1) * {LEAVE_QUOTA} + rn - 1 AS emp FROM leaving WHERE rn <= {LEAVE_QUOTA}"""
PARTS["held"] = """
    SELECT s.k, s.slot, q.m, q.d, q.lastq,
           coalesce(max(h.m) OVER (PARTITION BY s.k ORDER BY q.m), 0) AS h
    FROM slots s CROSS JOIN quarters q LEFT JOIN hired h ON h.k = s.k AND h.m = q.m"""
PARTS["roster"] = f"""
    SELECT *, CASE WHEN h = 0 THEN {chance(u('manager', 'emp'), 0.10)} ELSE {chance(u('manager', 'emp'), 0.05)} END AS mgr
    FROM (SELECT r.*, coalesce(h2.emp, 10000001 + r.slot) AS emp, hs.d AS hd
          FROM held r LEFT JOIN hired h2 ON h2.k = r.k AND h2.m = r.h JOIN spine hs ON hs.m = r.h)"""
PARTS["changing"] = f"""
    SELECT k, m FROM (SELECT k, m, row_number() OVER (PARTITION BY m ORDER BY cu, k) AS rn
                      FROM (SELECT k, m, {u('change', 'k', 'm')} AS cu FROM slots, spine WHERE m > 0))
    WHERE rn <= {CHANGE_QUOTA}"""
PARTS["flags"] = f"""
    SELECT r.*, c.k IS NOT NULL AS changed,
           c.k IS NOT NULL AND {chance(u('move', 'r.emp', 'r.m'), 0.3)} AS moved,
           c.k IS NOT NULL AND {chance(u('promote', 'r.emp', 'r.m'), 0.3)} AS promoted,
           r.m > 0 AND {chance(u('raise', 'r.emp', 'r.m'), 0.03)} AS raised
    FROM roster r LEFT JOIN changing c ON c.k = r.k AND c.m = r.m"""
PARTS["evolved"] = """
    SELECT *, max(CASE WHEN changed THEN m END) OVER w AS title_month,
           max(CASE WHEN moved THEN m END) OVER w AS move_month,
           sum(promoted::INTEGER) OVER w AS promotions,
           max(CASE WHEN raised THEN m END) OVER w AS raise_month,
           CASE WHEN lastq >= greatest(1, h) THEN lastq END AS quarter_month
    FROM flags WINDOW w AS (PARTITION BY emp ORDER BY m)"""

# -- organisation: one set of subqueries per source of blocks ---------------------

BLOCKS = {
    "r": f"""SELECT r_regionkey::BIGINT AS b, 'Sector ' || r_name AS name,
                    {_case('r_regionkey % 5', pools.BLOCK_IS_IT)} AS is_it,
                    ({_case('r_regionkey % 5', pools.BLOCK_SHARES)})::BIGINT AS share FROM region""",
    "s": """SELECT s_suppkey AS b, 'Sector ' || s_name AS name, s_nationkey % 5 = 0 AS is_it,
                   (1 + s_nationkey % 7)::BIGINT AS share FROM supplier""",
}


def _level(parent: str, level: int, low: int, high: int, it_pool, bank_pool, ending: str) -> str:
    node = ("b", "i2", "i3", "i4")
    index = [f"nth AS i{n}" if n == level else f"i{n}" for n in (2, 3, 4)]
    count = f"{low} + ({u(f'l{level}_count', *node)}) % {high - low + 1}"
    orders = {len(p): shuffled(f"l{level}_names", len(p), *node) for p in (it_pool, bank_pool)}

    def name(pool) -> str:
        return f"{text_list(pool)}[1 + ({orders[len(pool)]})[nth]]"

    own = tuple("nth" if n == level else f"i{n}" for n in (2, 3, 4))
    tail = ending.format(u3=u("l3_tag", "b", *own), u4=u("l4_number", "b", *own))
    return f"""
    SELECT b, {', '.join(index)}, {level} AS level,
           (CASE WHEN is_it THEN {name(it_pool)} ELSE {name(bank_pool)} END) {tail} AS name, is_it, share
    FROM (SELECT *, unnest(range(1, 1 + {count})) AS nth FROM {parent})"""


for p, blocks in BLOCKS.items():
    PARTS[f"{p}_blocks"] = blocks
    PARTS[f"{p}_l1"] = f"SELECT b, 0 AS i2, 0 AS i3, 0 AS i4, 1 AS level, name, is_it, share FROM {p}_blocks"
    PARTS[f"{p}_l2"] = _level(f"{p}_l1", 2, 3, 5, pools.L2_IT, pools.L2_BANK, "")
    PARTS[f"{p}_l3"] = _level(
        f"{p}_l2", 3, 2, 4, pools.L3_NAMES, pools.L3_NAMES, "|| ' ' || " + text_list(pools.L3_TAGS) + f"[1 + ({{u3}}) % {len(pools.L3_TAGS)}]"
    )
    PARTS[f"{p}_l4"] = _level(
        f"{p}_l3", 4, 2, 5, pools.L4_NAMES, pools.L4_NAMES, "|| '-' || (1 + ({u4}) % 99)::VARCHAR"
    )
    PARTS[f"{p}_all"] = f"""
    SELECT *, 1000 + row_number() OVER (ORDER BY b, i2, i3, i4) AS uid,
           CASE WHEN level = 4 THEN 600000 + ({u('leaf_weight', 'b', 'i2', 'i3', 'i4')}) % 1000001 END AS raw
    FROM (SELECT * FROM {p}_l1 UNION ALL SELECT * FROM {p}_l2 UNION ALL SELECT * FROM {p}_l3 UNION ALL SELECT * FROM {p}_l4)"""
    PARTS[f"{p}_spans"] = f"""
    SELECT b, ((before::HUGEINT * {RANGE}) // total)::BIGINT AS low, (((before + share)::HUGEINT * {RANGE}) // total)::BIGINT AS high,
           share::DOUBLE / total::DOUBLE AS part
    FROM (SELECT b, share, sum(share) OVER ()::BIGINT AS total,
                 (sum(share) OVER (ORDER BY b) - share)::BIGINT AS before FROM {p}_blocks)"""
    PARTS[f"{p}_units"] = f"""
    SELECT c.uid, c.level, c.name, c.is_it, c.raw,
           CASE c.level WHEN 1 THEN NULL WHEN 2 THEN a1.uid WHEN 3 THEN a2.uid ELSE a3.uid END AS parent_uid,
           list_filter([a1.uid, a2.uid, a3.uid, CASE WHEN c.level = 4 THEN c.uid END], lambda x: x IS NOT NULL) AS path,
           concat_ws(' / ', a1.name, a2.name, a3.name, CASE WHEN c.level = 4 THEN c.name END) AS full_name,
           c.raw::DOUBLE / (sum(c.raw) OVER (PARTITION BY c.b))::DOUBLE * s.part AS weight,
           CASE WHEN c.level = 4 THEN s.low + ((coalesce(sum(c.raw) OVER before, 0)::HUGEINT * (s.high - s.low)) // (sum(c.raw) OVER (PARTITION BY c.b))::HUGEINT)::BIGINT END AS low,
           CASE WHEN c.level = 4 THEN s.low + (((coalesce(sum(c.raw) OVER before, 0) + c.raw)::HUGEINT * (s.high - s.low)) // (sum(c.raw) OVER (PARTITION BY c.b))::HUGEINT)::BIGINT END AS high
    FROM {p}_all c JOIN {p}_spans s USING (b)
    JOIN {p}_all a1 ON a1.b = c.b AND a1.level = 1
    LEFT JOIN {p}_all a2 ON a2.b = c.b AND a2.level = 2 AND a2.i2 = c.i2
    LEFT JOIN {p}_all a3 ON a3.b = c.b AND a3.level = 3 AND a3.i2 = c.i2 AND a3.i3 = c.i3
    WINDOW before AS (PARTITION BY c.b ORDER BY c.uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
    PARTS[f"{p}_cover"] = f"""
    SELECT * FROM (SELECT *, coalesce(sum(w) OVER (ORDER BY cu, uid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
                          sum(w) OVER () AS total
                   FROM (SELECT uid, is_it, name, path[2] AS l2, high - low AS w, {u('cover_order', 'uid')} AS cu
                         FROM {p}_units WHERE level = 4))
    WHERE taken * 100 < total * 80"""
    PARTS[f"{p}_chunks"] = f"""
    SELECT *, (place - 1) // greatest(1, size // greatest(1, least(size, 1 + ({u('clusters', 'l2')}) % 3))) AS chunk
    FROM (SELECT *, row_number() OVER (PARTITION BY l2 ORDER BY ku, uid) AS place, count(*) OVER (PARTITION BY l2) AS size,
                 min(cu) OVER (PARTITION BY l2) AS first_u
          FROM (SELECT *, {u('cluster_order', 'uid')} AS ku FROM {p}_cover))"""
    PARTS[f"{p}_codes"] = f"""
    SELECT uid AS leaf_uid, is_it, name,
           5000 + dense_rank() OVER (ORDER BY first_u, l2) AS tribe_code,
           6000 + dense_rank() OVER (ORDER BY first_u, l2, chunk) AS cluster_code,
           7000 + row_number() OVER (ORDER BY first_u, l2, place) AS team_code
    FROM {p}_chunks"""
    PARTS[f"{p}_teams"] = f"""
    SELECT leaf_uid, tribe_code, cluster_code, team_code,
           CASE ({u('tribe_style', 'tribe_code')}) % 3
                WHEN 0 THEN 'Tribe ' || tribe_code || ': ' || theme
                WHEN 1 THEN theme || ' (' || {pick(u('tribe_mark', 'tribe_code'), pools.MARKS)} || ')'
                ELSE {pick(u('tribe_mark', 'tribe_code'), pools.MARKS)} || ' of ' || theme END AS tribe_name,
           CASE ({u('cluster_style', 'cluster_code')}) % 2
                WHEN 0 THEN 'Cluster ' || cluster_code || ': ' || topic
                ELSE topic || ', part ' || (cluster_code % 9 + 1) END AS cluster_name,
           CASE ({u('team_style', 'team_code')}) % 4
                WHEN 0 THEN nick
                WHEN 1 THEN nick || ' ' || CASE WHEN is_it THEN {pick(u('team_suffix', 'team_code'), pools.TEAM_SUFFIXES_IT)} ELSE {pick(u('team_suffix', 'team_code'), pools.TEAM_SUFFIXES_BANK)} END
                WHEN 2 THEN nick || ' from ' || split_part(name, ' ', -1)
                ELSE 'Team ' || team_code || ': ' || nick END AS team_name
    FROM (SELECT *,
                 CASE WHEN is_it THEN {pick(u('tribe_theme', 'tribe_code'), pools.TRIBE_THEMES_IT)} ELSE {pick(u('tribe_theme', 'tribe_code'), pools.TRIBE_THEMES_BANK)} END AS theme,
                 CASE WHEN is_it THEN {pick(u('cluster_theme', 'cluster_code'), pools.CLUSTER_THEMES_IT)} ELSE {pick(u('cluster_theme', 'cluster_code'), pools.CLUSTER_THEMES_BANK)} END AS topic,
                 {pick(u('team_nick', 'team_code'), pools.TEAM_NICKS)} AS nick
          FROM {p}_codes)"""

# -- placement and leaders ------------------------------------------------------------

PARTS["placed"] = f"""
    SELECT e.*, un.uid AS leaf_uid, un.name AS unit_name, un.level AS unit_level, un.is_it, un.path, un.full_name,
           t.tribe_name, t.tribe_code, t.cluster_name, t.cluster_code, t.team_name, t.team_code
    FROM (SELECT *, {pick_place('unit', 'emp', 'coalesce(move_month, 0)')} AS uu FROM evolved) e
    JOIN r_units un ON un.level = 4 AND un.low <= e.uu AND e.uu < un.high
    LEFT JOIN r_teams t ON t.leaf_uid = un.uid"""
PARTS["unit_lead"] = """
    SELECT m, uid, min(emp) AS leader FROM (SELECT m, emp, unnest(path) AS uid FROM placed WHERE mgr) GROUP BY ALL"""
PARTS["tribe_lead"] = """
    SELECT m, tribe_code, min(emp) AS leader FROM placed WHERE mgr AND tribe_code IS NOT NULL GROUP BY ALL"""
PARTS["cluster_lead"] = """
    SELECT m, cluster_code, min(emp) AS leader FROM placed WHERE mgr AND cluster_code IS NOT NULL GROUP BY ALL"""
PARTS["led"] = """
    SELECT p.*, coalesce(a.leader, 0) AS lid1, coalesce(b.leader, 0) AS lid2, coalesce(c.leader, 0) AS lid3,
           coalesce(t.leader, 0) AS lidt, coalesce(k.leader, 0) AS lidc
    FROM placed p
    LEFT JOIN unit_lead a ON a.m = p.m AND a.uid = p.path[1]
    LEFT JOIN unit_lead b ON b.m = p.m AND b.uid = p.path[2]
    LEFT JOIN unit_lead c ON c.m = p.m AND c.uid = p.path[3]
    LEFT JOIN tribe_lead t ON t.m = p.m AND t.tribe_code = p.tribe_code
    LEFT JOIN cluster_lead k ON k.m = p.m AND k.cluster_code = p.cluster_code"""
PARTS["asked"] = f"""
    SELECT k, m, kk, i1, i2 + (i2 >= i1)::BIGINT AS i2, x, least(i1, i2 + (i2 >= i1)::BIGINT) AS lo, greatest(i1, i2 + (i2 >= i1)::BIGINT) AS hi
    FROM (SELECT k, m, least(({u('successor_count', 'emp', 'm')}) % 4, {N} - 1) AS kk,
                 ({wide('successor1', 'emp', 'm')}) % {N} AS i1, ({wide('successor2', 'emp', 'm')}) % ({N} - 1) AS i2,
                 ({wide('successor3', 'emp', 'm')}) % ({N} - 2) AS x
          FROM roster)"""
PARTS["third"] = """
    SELECT k, m, kk, i1, i2, CASE WHEN x + (x >= lo)::BIGINT >= hi THEN x + (x >= lo)::BIGINT + 1 ELSE x + (x >= lo)::BIGINT END AS i3 FROM asked"""
PARTS["peers"] = """
    SELECT q.k, q.m, list(r.emp::VARCHAR ORDER BY q.place) AS peers
    FROM (SELECT k, m, kk, unnest([1, 2, 3]) AS place, unnest([i1, i2, i3]) AS idx FROM third) q
    JOIN roster r ON r.m = q.m AND r.slot = q.idx WHERE q.place <= q.kk GROUP BY q.k, q.m"""

# -- attributes -------------------------------------------------------------------------


def _by_gender(name: str, male, female) -> str:
    draw = u(name, "emp")
    return (
        f"CASE WHEN gender = 'M' THEN {pick(draw, male)} WHEN gender = 'F' THEN {pick(draw, female)} "
        f"ELSE {pick(draw, male + female)} END"
    )


def _latin(words):
    return [latin_word(w) for w in words]


def _two(draw: str, it_pool, bank_pool, flag: str = "hire_it") -> str:
    return f"CASE WHEN {flag} THEN {pick(draw, it_pool)} ELSE {pick(draw, bank_pool)} END"


def _two_taken(name: str, it_pool, bank_pool, k: str) -> str:
    return (
        f"CASE WHEN hire_it THEN {take(shuffled(name, len(it_pool), 'emp'), it_pool, k)} "
        f"ELSE {take(shuffled(name, len(bank_pool), 'emp'), bank_pool, k)} END"
    )


def _goal(texts) -> str:
    mark = (
        f"coalesce({text_list(pools.GOAL_MARKS)}[1 + ({u('goal_mark', 'emp', 'gi')}) % {len(pools.GOAL_MARKS) + 1}], "
        f"(5 + ({u('goal_number', 'emp', 'gi')}) % 91)::VARCHAR)"
    )
    order = shuffled("goals", len(texts), "emp")
    return f"list_transform(({order})[1:num_goals], lambda gi: replace({text_list(texts)}[1 + gi], '{{x}}', {mark}))"


STEMS = pools.PATRONYMIC_STEMS
PARTS["hire_rows"] = """
    SELECT DISTINCT emp, h, hd, mgr FROM roster"""
PARTS["people"] = f"""
    SELECT p.*, un.is_it AS hire_it,
           {choose(u('gender', 'emp'), pools.GENDER_WEIGHTS)} AS gender,
           (22 + ({u('age', 'emp')}) % 41)::INTEGER AS age_y,
           2 + ({u('goal_count', 'emp')}) % 4 AS num_goals,
           (3000 + ({u('completion', 'emp', 0)}) % 7001) / 10000.0::DOUBLE AS completion0,
           CASE WHEN h = 0 THEN hd - (30 + ({u('hire_date', 'emp')}) % 5446)::INTEGER ELSE hd - (({u('hire_date', 'emp')}) % 61)::INTEGER END AS hire_date
    FROM hire_rows p JOIN r_units un ON un.level = 4 AND un.low <= {pick_place('unit', 'p.emp', 0)} AND {pick_place('unit', 'p.emp', 0)} < un.high"""
PARTS["basics"] = f"""
    SELECT emp, h, hd, mgr, hire_it, gender, age_y, num_goals, completion0, hire_date,
           CASE WHEN age_y >= 24 THEN {choose(u('children', 'emp'), pools.CHILD_COUNT_WEIGHTS)} ELSE 0 END AS child_count,
           {choose(u('family', 'emp'), pools.FAMILY_WEIGHTS)} AS family_status,
           coalesce((gender = 'F' AND {chance(u('parental', 'emp'), 0.04)})::INTEGER, 0) AS is_parental_leave,
           ({u('vacation', 'emp')}) % 29 AS vac_days,
           {pick(u('university', 'emp'), pools.UNIVERSITIES)} AS university_name,
           {_two(u('speciality', 'emp'), pools.SPECIALITIES_IT, pools.SPECIALITIES_BANK)} AS speciality_name,
           (greatest(1985, year(hd) - age_y + 20) + ({u('education', 'emp')}) % (year(hd) - 1 - greatest(1985, year(hd) - age_y + 20) + 1))::VARCHAR || '-06-30' AS date_finish_education,
           CASE WHEN mgr THEN 1 + ({u('lead_years', 'emp')}) % least(25, greatest(1, age_y - 25))
                WHEN age_y > 28 AND {chance(u('led_before', 'emp'), 0.15)} THEN 1 + ({u('led_years', 'emp')}) % 5 ELSE 0 END AS lead_experience_years,
           {choose(u('career', 'emp'), pools.CAREER_WEIGHTS)} AS career_status,
           greatest(0, num_goals - round_even(num_goals * completion0, 0)::BIGINT) AS not_completed_goals
    FROM people"""
PARTS["goals_at_hire"] = f"""
    SELECT emp, num_goals, not_completed_goals, ({u('risked', 'emp')}) % (not_completed_goals + 1) AS risked_goals,
           CASE WHEN hire_it THEN {_goal(pools.GOALS_IT)} ELSE {_goal(pools.GOALS_BANK)} END AS goals
    FROM basics"""
PARTS["names"] = f"""
    SELECT emp, gender, {_by_gender('surname', pools.SURNAMES, FEMALE_SURNAMES)} AS person_surname,
           {_by_gender('first_name', pools.FIRST_NAMES_MALE, pools.FIRST_NAMES_FEMALE)} AS person_name,
           {_by_gender('patronymic', [s + 'ич' for s in STEMS], [s + 'на' for s in STEMS])} AS person_patronimics
    FROM people"""
PARTS["mails"] = f"""
    SELECT emp, slug || '@panel.example' AS wrk_email,
           slug || '.' || (10 + ({u('mail_number', 'emp')}) % 990)::VARCHAR || '@' || {pick(u('mail_domain', 'emp'), pools.MAIL_DOMAINS)} AS ext_email,
           '+7' || (9000000000 + ({wide('phone', 'emp')}) % 1000000000)::VARCHAR AS employee_kipphn
    FROM (SELECT emp, {_by_gender('first_name', _latin(pools.FIRST_NAMES_MALE), _latin(pools.FIRST_NAMES_FEMALE))} || '.' ||
                      {_by_gender('surname', _latin(pools.SURNAMES), _latin(FEMALE_SURNAMES))} || '.' || emp AS slug FROM people)"""
PARTS["talents"] = f"""
    SELECT emp,
           list_concat({_two_taken('skills', pools.SKILLS_IT, pools.SKILLS_BANK, f"3 + ({u('skill_count', 'emp')}) % 6")},
                       CASE WHEN mgr OR {chance(u('has_soft', 'emp'), 0.4)}
                            THEN {take(shuffled('soft_skills', len(pools.SKILLS_SOFT), 'emp'), pools.SKILLS_SOFT, f"1 + ({u('soft_count', 'emp')}) % 3")}
                            ELSE [] END) AS skills,
           list_concat(CASE WHEN CASE WHEN hire_it THEN {chance(u('english', 'emp'), 0.95)} ELSE {chance(u('english', 'emp'), 0.7)} END
                            THEN ['{pools.FIRST_LANGUAGE} / ' || CASE WHEN hire_it THEN {choose(u('english_level', 'emp'), pools.ENGLISH_IT_WEIGHTS)} ELSE {choose(u('english_level', 'emp'), pools.ENGLISH_BANK_WEIGHTS)} END]
                            ELSE [] END,
                       CASE WHEN {chance(u('second', 'emp'), 0.15)}
                            THEN [{pick(u('second_language', 'emp'), pools.OTHER_LANGUAGES)} || ' / ' || {pick(u('second_level', 'emp'), pools.OTHER_LEVELS)}]
                            ELSE [] END) AS langs,
           {_two_taken('achievements', pools.ACHIEVEMENTS_IT, pools.ACHIEVEMENTS_BANK, f"({u('achievement_count', 'emp')}) % 4")} AS achievements
    FROM people"""
PARTS["kids"] = f"""
    SELECT emp, child_count,
           list_transform(range(1, 1 + child_count), lambda ci: {choose(u('child_gender', 'emp', 'ci'), pools.CHILD_GENDER_WEIGHTS)}) AS genders,
           list_transform(range(1, 1 + child_count), lambda ci: ({u('child_years', 'emp', 'ci')}) % (1 + least(25, age_y - 20))) AS years
    FROM basics"""
PARTS["monthly"] = f"""
    SELECT e.emp, e.m, e.d, e.h, e.k, date_diff('day', b.hire_date, e.d) AS tenure, e.raise_month,
           CASE WHEN e.raise_month IS NOT NULL THEN 30 * (e.m - e.raise_month)
                ELSE ({u('raise_base', 'e.emp')}) % 901 + 30 * (e.m - greatest(0, e.h - 1)) END AS raise_days,
           e.quarter_month, b.hire_date,
           {choose(u('fp_res', 'e.emp', 'coalesce(e.quarter_month, 0)'), pools.RESULT_WEIGHTS)} AS fp_res,
           {choose(u('fp_comp', 'e.emp', 'coalesce(e.quarter_month, 0)'), pools.COMPETENCE_WEIGHTS)} AS fp_comp,
           (3000 + ({u('completion', 'e.emp', 'coalesce(e.quarter_month, 0)')}) % 7001) / 10000.0::DOUBLE AS completion,
           CASE WHEN e.mgr THEN 11 + ({u('grade', 'e.emp')}) % 4 ELSE 7 + ({u('grade', 'e.emp')}) % 7 END AS base_grade,
           e.promotions
    FROM evolved e JOIN people b USING (emp)"""
WORDS = "|".join(pools.UNIT_WORDS)
PARTS["titles"] = f"""
    SELECT emp, m,
           CASE WHEN mgr THEN '{pools.MANAGER_TITLE} ' || {text_list(pools.LEVEL_WORDS.values())}[unit_level] || ' ' || regexp_replace(unit_name, '^({WORDS}) ', '')
                ELSE {_two(u('position', 'emp', 'coalesce(title_month, 0)'), pools.POSITIONS_IT, pools.POSITIONS_BANK, 'is_it')} END AS position_name,
           CASE WHEN mgr THEN '{pools.MANAGER_PROFESSION}'
                ELSE {_two(u('profession', 'emp', 'coalesce(title_month, 0)'), pools.PROFESSIONS_IT, pools.PROFESSIONS_BANK, 'is_it')} END AS professionlevel_name
    FROM placed"""

PANEL_EXPRESSIONS = {
    "report_date": ("led", "l.d"), "employee_id": ("led", "l.emp::VARCHAR"),
    "grade_num": ("monthly", "least(17, mo.base_grade + mo.promotions)"),
    "position_name": ("titles", "ti.position_name"), "unit_id_tree": ("led", "l.path"),
    "person_surname": ("names", "na.person_surname"), "person_name": ("names", "na.person_name"),
    "person_patronimics": ("names", "na.person_patronimics"), "gender": ("names", "na.gender"),
    "age_y": ("basics", "ba.age_y"), "wrk_email": ("mails", "ma.wrk_email"), "ext_email": ("mails", "ma.ext_email"),
    "employee_kipphn": ("mails", "ma.employee_kipphn"), "child_count": ("basics", "ba.child_count"),
    "family_status": ("basics", "ba.family_status"), "is_on_trial": ("monthly", "(mo.tenure < 90)::INTEGER"),
    "sber_los_cnt_days": ("monthly", "mo.tenure"), "is_parental_leave": ("basics", "ba.is_parental_leave"),
    "all_skills": ("talents", "ta.skills"), "date_since_salary_change_last": ("monthly", "mo.raise_days"),
    "po_i_pernr": ("led", "l.lid3"), "fp_res": ("monthly", "mo.fp_res"), "fp_comp": ("monthly", "mo.fp_comp"),
    "full_oshs_name": ("led", "l.full_name"), "all_succesors": ("peers", "coalesce(pe.peers, [])"),
    "children_gender": ("kids", "ki.genders"), "children_years": ("kids", "ki.years"),
    "lang_with_level": ("talents", "ta.langs"), "tribe_name": ("led", "l.tribe_name"),
    "cluster_name": ("led", "l.cluster_name"), "team_name": ("led", "l.team_name"),
    "tribe_code": ("led", "l.tribe_code"), "cluster_code": ("led", "l.cluster_code"), "team_code": ("led", "l.team_code"),
    "all_goals_desc": ("goals_at_hire", "go.goals"), "mean_value_completion": ("monthly", "mo.completion"),
    "num_goals": ("goals_at_hire", "go.num_goals"), "not_completed_goals": ("goals_at_hire", "go.not_completed_goals"),
    "risked_goals": ("goals_at_hire", "go.risked_goals"), "achievement_desc": ("talents", "ta.achievements"),
    "career_status": ("basics", "ba.career_status"), "university_name": ("basics", "ba.university_name"),
    "speciality_name": ("basics", "ba.speciality_name"), "date_finish_education": ("basics", "ba.date_finish_education"),
    "lead_experience_years": ("basics", "ba.lead_experience_years"),
    "professionlevel_name": ("titles", "ti.professionlevel_name"), "vac_days": ("basics", "ba.vac_days"),
    "lid_tribe_i_pernr": ("led", "l.lidt"), "lid_1_lvl_i_pernr": ("led", "l.lid1"), "lid_2_lvl_i_pernr": ("led", "l.lid2"),
    "lid_3_lvl_i_pernr": ("led", "l.lid3"), "lid_cluster_i_pernr": ("led", "l.lidc"),
    "it_lid_cluster_i_pernr": ("led", "l.lidc"), "cur_tribe_i_pernr": ("led", "l.lidt"),
}
PANEL_JOINS = {
    "monthly": ("mo", "mo.emp = l.emp AND mo.m = l.m"), "titles": ("ti", "ti.emp = l.emp AND ti.m = l.m"),
    "names": ("na", "na.emp = l.emp"), "basics": ("ba", "ba.emp = l.emp"), "mails": ("ma", "ma.emp = l.emp"),
    "talents": ("ta", "ta.emp = l.emp"), "kids": ("ki", "ki.emp = l.emp"), "goals_at_hire": ("go", "go.emp = l.emp"),
    "peers": ("pe", "pe.k = l.k AND pe.m = l.m"),
}
SQL_TYPES = {"date": "DATE", "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


def panel_select(columns, texts: bool = True, as_text_date: bool = False, base: str = "led") -> str:
    """SELECT of panel columns; ``base`` may be ``placed`` where no leader column is wanted."""
    types = {f.name: f.dataType.simpleString() for f in PANEL}
    needed = dict.fromkeys(PANEL_EXPRESSIONS[c][0] for c in columns)
    out = []
    for c in columns:
        text = PANEL_EXPRESSIONS[c][1]
        if c in ARRAY_COLUMNS:
            text = json_text(text) if texts else text
        elif c == "report_date" and as_text_date:
            text = f"strftime({text}, '%Y-%m-%d')"
        else:
            text = f"({text})::{SQL_TYPES[types[c]]}"
        out.append(f"{text} AS {c}")
    joins = " ".join(
        f"{'LEFT ' if n == 'peers' else ''}JOIN {n} {PANEL_JOINS[n][0]} ON {PANEL_JOINS[n][1]}" for n in needed if n != "led"
    )
    return f"SELECT {', '.join(out)} FROM {base} l {joins}"


def with_parts(sql: str) -> str:
    """Puts the subqueries that ``sql`` names in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        plain = re.sub(r"'(?:[^']|'')*'", "''", text)
        for name in PARTS:
            if name not in order and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", plain):
                visit(PARTS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in order) + "\n" + sql


def only_employee(sql: str, employee: str) -> str:
    """Builds everything that hangs on the roster for one employee alone."""
    whole = f"roster AS MATERIALIZED ({PARTS['roster']})"
    one = f"roster_all AS MATERIALIZED ({PARTS['roster']}),\nroster AS MATERIALIZED (SELECT * FROM roster_all WHERE emp = {employee})"
    assert whole in sql
    return sql.replace(whole, one)


# Alias table over the leaves of the supplier organisation: what light options lack and heavy ones have too much, on one line.
PARTS["alias_line"] = """
    SELECT k, slot, n, total, ov, coalesce(sum(greatest(-ov, 0)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lacking,
           coalesce(sum(greatest(ov, 0)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS spent
    FROM (SELECT k, slot, n, total, w::HUGEINT * n - total AS ov
          FROM (SELECT uid AS k, raw AS w, row_number() OVER (ORDER BY uid) - 1 AS slot, count(*) OVER () AS n, (sum(raw) OVER ())::HUGEINT AS total FROM s_units WHERE level = 4))"""
PARTS["alias_rows"] = f"""
    SELECT k, slot, n, CASE WHEN ov < 0 THEN filler WHEN ov > 0 THEN following ELSE following END AS alias,
           ((CASE WHEN ov < 0 THEN total + ov WHEN ov > 0 THEN total - (until - spent) ELSE total END) * {2**62}::HUGEINT // total)::BIGINT AS cut
    FROM (SELECT x.*, (SELECT min_by(h.k, h.spent) FROM alias_line h WHERE h.ov > 0 AND h.spent > x.lacking) AS filler,
                 (SELECT min(l.lacking - l.ov) FROM alias_line l WHERE l.ov < 0 AND l.lacking - l.ov >= x.spent) AS until,
                 (SELECT min_by(h.k, h.slot) FROM alias_line h WHERE h.ov > 0 AND h.slot > x.slot) AS following
          FROM alias_line x)"""

# -- the queries ------------------------------------------------------------------------

LATEST = "d = (SELECT max(d) FROM spine)"
SCORE = "CASE fp_res WHEN 'A' THEN 5 WHEN 'B' THEN 4 WHEN 'C' THEN 3 WHEN 'D' THEN 2 WHEN 'E' THEN 1 END"


def _mean(total: str, count: str, digits: int, divisor: int = 1) -> str:
    """Mean rounded half up, in integers."""
    unit = 10**digits
    return f"((2 * {unit} * ({total})::BIGINT + ({count}) * {divisor}) // (2 * ({count}) * {divisor})) / {float(unit)}::DOUBLE"


def oracles() -> dict[str, str]:
    arrays = lambda *cols: panel_select(cols)
    history = ["report_date", "position_name", "grade_num", "sber_los_cnt_days", "tribe_name", "team_name", "fp_res", "fp_comp"]
    full = "SELECT emp FROM roster GROUP BY emp HAVING count(*) = (SELECT count(DISTINCT m) FROM roster)"
    one = f"SELECT emp FROM (SELECT emp, {u('random_entity', 'emp')} AS ru FROM ({full})) ORDER BY ru, emp::VARCHAR LIMIT 1"
    months = "(SELECT *, last_day(o_orderdate)::DATE AS d FROM orders)"
    first, last = f"(SELECT min(d) FROM {months})", f"(SELECT max(d) FROM {months})"
    skill_rows = f"(SELECT l.emp, mo.fp_res, unnest(ta.skills) AS skill FROM roster l JOIN talents ta ON ta.emp = l.emp JOIN monthly mo ON mo.emp = l.emp AND mo.m = l.m WHERE l.{LATEST})"
    holders = (
        "SELECT count(DISTINCT emp) AS python_users, CASE WHEN count({s}) > 0 THEN {mean} END AS avg_fp_res "
        "FROM {rows} WHERE skill = '{skill}'"
    )
    mean = _mean(f"sum({SCORE})", f"greatest(count({SCORE}), 1)", 2)
    sampled = f"SELECT emp FROM (SELECT emp, row_number() OVER (ORDER BY eu, emp) AS rn FROM (SELECT DISTINCT emp, {u('entity_sample', 'emp')} AS eu FROM roster)) WHERE rn <= {SAMPLE}"
    hire = "b.emp::VARCHAR AS employee_id"
    q: dict[str, str] = {}
    q["scan_panel"] = q["panel_rows"] = panel_select(PANEL_COLUMNS)
    q["panel_roundtrip"] = """SELECT l.d AS report_date, count(*) AS n, count(DISTINCT l.emp) AS members, sum(len(ta.skills))::BIGINT AS skills,
        sum(least(17, mo.base_grade + mo.promotions))::BIGINT AS grades, count(l.tribe_code) AS in_tribe, sum(l.lid1)::BIGINT AS leader_sum
        FROM led l JOIN talents ta ON ta.emp = l.emp JOIN monthly mo ON mo.emp = l.emp AND mo.m = l.m GROUP BY l.d"""
    q["appended_month"] = panel_select(PANEL_COLUMNS) + f" WHERE l.m >= {MONTHS - 2}"
    q["flat_export"] = panel_select(PANEL_COLUMNS, as_text_date=True) + f" WHERE l.emp IN ({sampled})"
    for key, end in (("latest_snapshot", "max"), ("earliest_snapshot", "min")):
        q[key] = arrays("report_date", "employee_id", "grade_num").replace("FROM led l", "FROM roster l") + f" WHERE l.d = (SELECT {end}(d) FROM spine)"
        q[f"orders_{key}"] = f"SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, d AS report_date FROM {months} WHERE d = (SELECT {end}(d) FROM {months})"
    q["latest_stored_month"] = f"""SELECT d AS report_date, tribe_code::INTEGER AS tribe_code, count(*) AS headcount, (SELECT min(d) FROM spine)::DATE AS first_month,
        (SELECT count(DISTINCT d) FROM roster)::BIGINT AS n_months FROM placed WHERE {LATEST} GROUP BY ALL"""
    q["headcount_by_snapshot"] = "SELECT d AS report_date, count(*) AS headcount FROM roster GROUP BY d ORDER BY d"
    q["orders_by_month"] = f"SELECT d AS report_date, count(*) AS headcount FROM {months} GROUP BY d"
    q["org_headcount"] = q["flat_org_headcount"] = f"""SELECT path[1] AS l1_uid, split_part(full_name, ' /', 1) AS l1_name, count(*) AS headcount
        FROM placed WHERE {LATEST} GROUP BY ALL"""
    q["top_groups"] = f"""SELECT tribe_name, tribe_code::INTEGER AS tribe_code, count(*) AS headcount FROM placed
        WHERE {LATEST} AND tribe_name IS NOT NULL GROUP BY ALL ORDER BY headcount DESC, tribe_code, tribe_name LIMIT 10"""
    q["orders_top_groups"] = f"""SELECT o_orderpriority, o_orderstatus, count(*) AS headcount FROM {months}
        WHERE d = {last} AND o_orderpriority IS NOT NULL GROUP BY ALL ORDER BY headcount DESC, o_orderstatus, o_orderpriority LIMIT 10"""
    q["grade_profile"] = f"""SELECT least(17, base_grade + promotions)::INTEGER AS grade_num, count(*) AS n, {_mean(f'sum({SCORE})', f'count({SCORE})', 2)} AS avg_fp_res,
        {_mean('sum(tenure)', 'count(tenure)', 1, 365)} AS avg_tenure_years FROM monthly WHERE {LATEST} GROUP BY 1"""
    q["skill_holders"] = holders.format(s=SCORE, mean=mean, rows=skill_rows, skill="Python")
    q["skill_holders_none"] = holders.format(s=SCORE, mean=mean, rows=skill_rows, skill="COBOL")
    q["skill_popularity"] = f"SELECT skill, count(*) AS n FROM {skill_rows} GROUP BY skill ORDER BY n DESC, skill LIMIT 15"
    q["part_word_popularity"] = "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY word ORDER BY n DESC, word LIMIT 15"

    def diff(rows: str, member: str, lo: str, hi: str) -> str:
        at = lambda d: f"(SELECT count(*) FROM {rows} WHERE d = {d})"
        lost = lambda a, b: f"(SELECT count(*) FROM {rows} WHERE d = {a} AND {member} NOT IN (SELECT {member} FROM {rows} WHERE d = {b}))"
        return f"SELECT {at(lo)} AS at_start, {at(hi)} AS at_end, {lost(lo, hi)} AS left_company, {lost(hi, lo)} AS hired"

    q["snapshot_diff"] = diff("roster", "emp", "(SELECT min(d) FROM spine)", "(SELECT max(d) FROM spine)")
    q["orders_snapshot_diff"] = diff(months, "o_custkey", first, last)
    q["orders_gone"] = f"SELECT o_orderkey, o_custkey FROM {months} WHERE d = {first} AND o_custkey NOT IN (SELECT o_custkey FROM {months} WHERE d = {last})"
    q["full_history"] = f"SELECT emp::VARCHAR AS employee_id FROM ({full})"
    q["random_entity"] = f"SELECT emp::VARCHAR AS employee_id FROM ({one})"
    q["entity_lookup"] = panel_select(history, base="placed")
    q["regex_share"] = f"""SELECT round(avg(regexp_matches(lower(position_name), lower('{pools.IT_TITLE_PATTERN}'))::INTEGER::DOUBLE), 9) AS it_share
        FROM titles WHERE m = 0"""
    q["part_regex_share"] = "SELECT p_type, round(avg((p_name SIMILAR TO '(red|blue).*' AND p_partkey % 3 <> 2)::INTEGER::DOUBLE), 9) AS share FROM part GROUP BY p_type"
    q["panel_roster"] = "SELECT d AS report_date, emp AS employee_id, slot, k AS slot_key, h::BIGINT AS hire_month, mgr::INTEGER AS is_manager FROM roster"
    q["roster_turnover"] = """SELECT r.d AS report_date, count(*) AS headcount, coalesce(any_value(x.n), 0) AS left_company,
        count(*) FILTER (r.h = r.m AND r.m > 0) AS hired FROM roster r LEFT JOIN (SELECT m, count(*) AS n FROM hired GROUP BY m) x ON x.m = r.m GROUP BY r.d"""
    q["tenure"] = "SELECT mo.d AS report_date, mo.emp AS employee_id, mo.hire_date, mo.tenure::INTEGER AS tenure_days, (mo.tenure < 90)::INTEGER AS is_on_trial FROM monthly mo"
    q["raise_counter"] = "SELECT d AS report_date, emp AS employee_id, raise_month, raise_days::INTEGER AS days_since_raise FROM monthly"
    q["quarter_refresh"] = "SELECT d AS report_date, emp AS employee_id, quarter_month, fp_res, fp_comp, completion AS mean_value_completion FROM monthly"
    q["unit_moves"] = "SELECT d AS report_date, emp AS employee_id, title_month, move_month, leaf_uid FROM placed"
    q["grade_growth"] = "SELECT d AS report_date, emp AS employee_id, base_grade::INTEGER AS base_grade, promotions::INTEGER AS promotions, least(17, base_grade + promotions)::INTEGER AS grade_num FROM monthly"
    q["seeded_draw"] = f"SELECT c_custkey, {u('trial', 'c_custkey')} AS u, {u('trial', 'c_custkey', 'c_nationkey')} AS u_pair, {u('trial', 'c_custkey', seed=7)} AS u_other_seed FROM customer"
    base = ["child_count", "family_status", "is_parental_leave", "vac_days", "lead_experience_years", "num_goals"]
    q["base_attributes"] = f"""SELECT {hire}, age_y, {', '.join(f'{c}::INTEGER AS {c}' for c in base)}, university_name, speciality_name,
        date_finish_education, career_status, CASE WHEN month(hd) IN (3, 6, 9, 12) AND h > 0 THEN mo.completion ELSE completion0 END AS mean_value_completion
        FROM basics b JOIN (SELECT emp, m, completion FROM monthly) mo ON mo.emp = b.emp AND mo.m = b.h"""
    urgent = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
    q["weighted_category"] = f"""SELECT o_orderkey, {choose(u('gender', 'o_orderkey'), pools.GENDER_WEIGHTS)} AS gender,
        {choose(u('career', 'o_orderkey'), pools.CAREER_WEIGHTS)} AS career_status,
        CASE WHEN {urgent} THEN {choose(u('segment', 'o_orderkey'), pools.ENGLISH_IT_WEIGHTS)} ELSE {choose(u('segment', 'o_orderkey'), pools.ENGLISH_BANK_WEIGHTS)} END AS level,
        {chance(u('flag', 'o_orderkey'), 0.04)}::INTEGER AS flag, ({u('days', 'o_orderkey')}) % 29 AS days,
        (3000 + ({u('share', 'o_orderkey')}) % 7001) / 10000.0::DOUBLE AS share, {pick(u('school', 'o_orderkey'), pools.UNIVERSITIES)} AS school FROM orders"""
    q["person_names"] = f"SELECT {hire}, gender, person_surname, person_name, person_patronimics FROM names b"
    q["contacts"] = f"SELECT {hire}, wrk_email, ext_email, employee_kipphn FROM mails b"
    q["skill_sets"] = f"SELECT {hire}, {json_text('skills')} AS all_skills, {json_text('langs')} AS lang_with_level, {json_text('achievements')} AS achievement_desc FROM talents b"
    q["children_arrays"] = f"SELECT {hire}, child_count, {json_text('genders')} AS children_gender, {json_text('years')} AS children_years FROM kids b"
    q["goal_shortfall"] = f"SELECT {hire}, {json_text('goals')} AS all_goals_desc, num_goals::INTEGER AS num_goals, not_completed_goals::INTEGER AS not_completed_goals, risked_goals::INTEGER AS risked_goals FROM goals_at_hire b"
    q["org_tree"] = "SELECT uid, parent_uid, level, name, is_it::INTEGER AS is_it FROM s_units"
    q["org_paths"] = f"SELECT uid, path[1] AS l1_uid, {json_text('path')} AS path, full_name FROM s_units"
    q["block_shares"] = "SELECT uid, raw AS raw_weight, round(weight, 12) AS weight, low AS pick_low, high AS pick_high FROM s_units WHERE level = 4"
    q["greedy_cover"] = f"""SELECT p_partkey, p_size, u FROM (SELECT *, coalesce(sum(p_size) OVER (ORDER BY u, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken
        FROM (SELECT p_partkey, p_size::BIGINT AS p_size, {u('cover', 'p_partkey')} AS u FROM part)) WHERE taken * 100 < (SELECT sum(p_size) FROM part) * 80"""
    q["agile_structure"] = "SELECT leaf_uid, tribe_code::INTEGER AS tribe_code, cluster_code::INTEGER AS cluster_code, team_code::INTEGER AS team_code FROM s_codes"
    q["templated_labels"] = "SELECT team_code::INTEGER AS team_code, tribe_name, cluster_name, team_name FROM s_teams"
    q["agile_assignment"] = "SELECT d AS report_date, emp::VARCHAR AS employee_id, tribe_name, tribe_code::INTEGER AS tribe_code, cluster_code::INTEGER AS cluster_code, team_name, team_code::INTEGER AS team_code FROM placed"
    q["weighted_assignment"] = f"SELECT o_orderkey, un.uid AS leaf_uid FROM (SELECT o_orderkey, {pick_place('assign', 'o_orderkey')} AS ou FROM orders) o JOIN s_units un ON un.level = 4 AND un.low <= ou AND ou < un.high"
    q["subtree_headcount"] = "SELECT d AS report_date, uid, count(*) AS headcount FROM (SELECT d, unnest(path) AS uid FROM placed) GROUP BY ALL"
    q["unit_leaders"] = "SELECT s.d AS report_date, uid, leader FROM unit_lead JOIN spine s USING (m)"
    q["agile_leaders"] = """SELECT s.d AS report_date, 'tribe' AS kind, tribe_code::INTEGER AS code, leader FROM tribe_lead JOIN spine s USING (m)
        UNION ALL SELECT s.d, 'cluster', cluster_code::INTEGER, leader FROM cluster_lead JOIN spine s USING (m)"""
    q["leader_columns"] = arrays("report_date", "employee_id", "po_i_pernr", "lid_1_lvl_i_pernr", "lid_2_lvl_i_pernr", "lid_3_lvl_i_pernr", "lid_tribe_i_pernr", "lid_cluster_i_pernr", "it_lid_cluster_i_pernr", "cur_tribe_i_pernr")
    q["random_peers"] = panel_select(["report_date", "employee_id", "all_succesors"], base="roster")
    q["exact_k_sample"] = f"""SELECT o_orderkey, o_orderpriority, u FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY u, o_orderkey) AS rn
        FROM (SELECT o_orderkey, o_orderpriority, {u('sample', 'o_orderkey')} AS u FROM orders)) WHERE rn <= 100 * (SELECT count(*) FROM region)"""
    q["exact_k_sample_nullable"] = f"""SELECT o_orderkey, grp, u FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY u, o_orderkey) AS rn
        FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS grp, {u('sample', 'o_orderkey')} AS u FROM orders)) WHERE rn <= 100 * (SELECT count(*) FROM region)"""
    q["flat_export_all"] = panel_select(PANEL_COLUMNS, as_text_date=True)
    for key in ("skill_holders", "skill_popularity", "top_groups"):
        q[f"flat_{key}"] = q[key]
    q["entity_sample"] = f"""SELECT o_orderkey, o_custkey, o_orderdate::DATE AS o_orderdate FROM orders WHERE o_custkey IN
        (SELECT o_custkey FROM (SELECT o_custkey, row_number() OVER (ORDER BY eu, o_custkey) AS rn FROM (SELECT DISTINCT o_custkey, {u('entity_sample', 'o_custkey')} AS eu FROM orders)) WHERE rn <= {SAMPLE})"""
    q["month_spine"] = """SELECT s.o_custkey, s.month_end, coalesce(c.n, 0) AS n, (month(s.month_end) IN (3, 6, 9, 12))::INTEGER AS quarter_end, year(s.month_end)::INTEGER AS year
        FROM (SELECT o_custkey, last_day(unnest(range(min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate)) + INTERVAL 1 DAY, INTERVAL 1 MONTH)))::DATE AS month_end FROM orders GROUP BY o_custkey) s
        LEFT JOIN (SELECT o_custkey, last_day(o_orderdate)::DATE AS month_end, count(*) AS n FROM orders GROUP BY ALL) c ON c.o_custkey = s.o_custkey AND c.month_end = s.month_end"""
    words = "list_transform(string_split(p_name, ' '), lambda w: CASE WHEN w <> 'red' THEN w || ' «я»' END)"
    q["array_to_json"] = f"SELECT p_partkey, {json_text(words)} AS words, {json_text('[p_partkey, p_size::BIGINT]')} AS numbers, {json_text(f'({words})[1:p_size % 2]')} AS maybe_empty FROM part"
    pieces = "list_transform(string_split(p_name, ' '), lambda w: CASE WHEN w <> 'red' THEN string_split(w, 'e') END)"
    inner = f"list_transform({pieces}, lambda ps: CASE WHEN ps IS NULL THEN 'null' ELSE '[\"' || array_to_string(ps, '\", \"') || '\"]' END)"
    q["nested_array_to_json"] = f"""SELECT p_partkey, '[' || array_to_string({inner}, ', ') || ']' AS words,
        '[[[' || p_partkey || ', ' || p_size || ']], []]' AS deep FROM part"""
    q["json_first"] = "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract('[' || json_extract_string(props, '$.k') || ', 7]', '$[0]')::BIGINT AS first_item FROM events"
    q["prefix_extract"] = "SELECT p_partkey, CASE WHEN strpos(p_name, ' ') > 0 THEN substr(p_name, 1, strpos(p_name, ' ') - 1) ELSE '' END AS first_word, '' AS none FROM part"
    q["strip_keyword"] = "SELECT p_partkey, regexp_replace(p_name, '^(red|blue|hot|small) ', '') AS bare FROM part"
    q["last_token"] = "SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN string_split(p_name, ' ')[-1] ELSE p_brand END AS tail FROM part"
    q["half_even"] = "SELECT l_orderkey, sum(round_even(l_quantity * 0.5::DOUBLE, 0))::BIGINT AS halves, sum(greatest(0, least(30, l_quantity::BIGINT - 5)))::BIGINT AS clamped FROM lineitem GROUP BY l_orderkey"
    q["alias_assignment"] = f"""
        SELECT o_orderkey, CASE WHEN ou < cut THEN k ELSE coalesce(alias, k) END AS leaf_uid
        FROM (SELECT o_orderkey, {wide('alias_slot', 'o_orderkey')} AS os, {pick_place('alias_cut', 'o_orderkey')} AS ou FROM orders) o
        JOIN alias_rows a ON a.slot = os % a.n"""

    def pairs(rows: str, member: str) -> str:
        """Every pair of periods by the plain set form."""
        return f"""SELECT a.d AS first, b.d AS last, a.n AS at_start, b.n AS at_end, a.n - coalesce(s.n, 0) AS left_company, b.n - coalesce(s.n, 0) AS hired
            FROM (SELECT d, count(DISTINCT {member}) AS n FROM {rows} GROUP BY d) a JOIN (SELECT d, count(DISTINCT {member}) AS n FROM {rows} GROUP BY d) b ON a.d < b.d
            LEFT JOIN (SELECT x.d AS d1, y.d AS d2, count(*) AS n FROM (SELECT DISTINCT d, {member} AS e FROM {rows}) x JOIN (SELECT DISTINCT d, {member} AS e FROM {rows}) y
                       ON x.e = y.e AND x.d < y.d GROUP BY ALL) s ON s.d1 = a.d AND s.d2 = b.d"""

    q["turnover_pairs"] = pairs("roster", "emp")
    q["orders_turnover_pairs"] = pairs(months, "o_custkey")
    q["presence_counts"] = f"SELECT (SELECT count(*) FROM ({full}))::BIGINT AS n, (SELECT count(DISTINCT emp) FROM roster)::BIGINT AS ever"
    q["deep_subtree_headcount"] = f"""
        WITH RECURSIVE edge AS MATERIALIZED (SELECT c_custkey AS k, CASE WHEN c_custkey BETWEEN 2 AND {CHAIN} THEN c_custkey - 1
                WHEN c_custkey > {CHAIN} THEN 1 + {u('below', 'c_custkey')} % (c_custkey - 1) END AS p FROM customer),
        down AS (SELECT k, [k] AS path FROM edge WHERE p IS NULL UNION ALL SELECT e.k, list_append(d.path, e.k) FROM edge e JOIN down d ON e.p = d.k),
        laid AS MATERIALIZED (SELECT k, path, len(path)::BIGINT AS depth, row_number() OVER (ORDER BY path) - 1 AS pos FROM down),
        own AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey),
        sums AS (SELECT a AS k, count(*) AS units, coalesce(sum(n), 0)::BIGINT AS orders FROM (SELECT k, unnest(path) AS a FROM laid) LEFT JOIN own USING (k) GROUP BY a)
        SELECT k AS c_custkey, pos AS first, pos + units - 1 AS last, depth, units, orders FROM laid JOIN sums USING (k)"""
    cell = permutation_step("x", "nr", "nc", "parts", "c_custkey")
    q["part_picks"] = f"""
        WITH RECURSIVE square AS MATERIALIZED (SELECT n, nr, (n + nr - 1) // nr AS nc FROM (SELECT n, ceil(sqrt(n))::BIGINT AS nr FROM (SELECT count(*) AS n FROM part))),
        walk AS (SELECT c_custkey, x AS nth, n, nr, nc, {cell} AS x FROM customer, square, range(5) r(x)
                 UNION ALL SELECT c_custkey, nth, n, nr, nc, {cell} AS x FROM walk WHERE x >= n),
        numbered AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS ordinal FROM part)
        SELECT c_custkey, nth::INTEGER AS place, p_partkey FROM walk JOIN numbered ON x = ordinal WHERE x < n"""
    q["price_rank"] = """SELECT o_orderkey, cents, row_number() OVER (ORDER BY cents, o_orderkey) - 1 AS place
        FROM (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders)"""
    q["entity_history"] = panel_select(history, base="placed")
    narrow = panel_select(["report_date", "employee_id", "grade_num", "position_name", "tribe_code", "cluster_code"], base="placed")
    wanted = {"employee_id": "'10000001'", **{c: f"(SELECT min({c}) FROM ({narrow}))" for c in ("tribe_code", "cluster_code", "position_name")}}
    q["point_lookup_layout"] = " UNION ALL ".join(
        f"SELECT '{c}' AS path, {c}::VARCHAR AS value, report_date, count(*) AS n, sum(grade_num)::BIGINT AS grades FROM ({narrow}) WHERE {c} = {v} GROUP BY ALL"
        for c, v in wanted.items()
    )
    picked = {"entity_lookup": "10000001", "entity_history": f"({one.replace('FROM roster', 'FROM roster_all')})"}
    return {name: only_employee(with_parts(sql), picked[name]) if name in picked else with_parts(sql) for name, sql in q.items()}
