"""English stems in SQL, step by step over distinct words."""

from __future__ import annotations

from palaver.functions import stems


def _case(column: str, table: dict[str, str]) -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + f" ELSE {column} END"


def _ending(suffixes) -> str:
    return f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"


KEPT = ", ".join(f"'{w}'" for w in stems.UNCHANGED)
BASE = "left(w, length(w) - length(s))"
IN_R1, IN_R2 = ("s <> '' AND length(w) - length(s) >= " + r for r in ("r1", "r2"))


def stem_tables(source: str) -> str:
    """CTEs that end in ``stems(term, stem)``, from a table of distinct words ``term``."""
    def step(name: str, before: str, suffixes, body: str) -> str:
        suffix = _ending(suffixes) if suffixes else "''"
        return f"""{name} AS (SELECT term, r1, r2, CASE WHEN w IN ({KEPT}) THEN w ELSE {body} END AS w
            FROM (SELECT *, {suffix} AS s FROM {before}))"""
    parts = [
        f"st_y AS (SELECT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') AS w FROM {source})",
        f"""st_a AS (SELECT term, w, CASE WHEN e <> '' THEN length(e) ELSE length(w) END AS r1
            FROM (SELECT *, regexp_extract(w, '{stems.FIRST_REGION}', 1) AS e FROM st_y))""",
        """st_b AS (SELECT term, w, r1, CASE WHEN e <> '' THEN r1 + length(e) ELSE length(w) END AS r2
            FROM (SELECT *, regexp_extract(substr(w, r1 + 1), '^(.*?[aeiouy][^aeiouy])', 1) AS e FROM st_a))""",
        """st_0 AS (SELECT term, r1, r2, CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
            WHEN regexp_matches(w, 'ie[sd]$') THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
            WHEN regexp_matches(w, '(us|ss)$') THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN left(w, length(w) - 1) ELSE w END AS w FROM st_b)""",
        f"""st_1 AS (SELECT term, r1, r2, CASE WHEN w IN ({KEPT}) OR s = '' THEN w
            WHEN s IN ('eed', 'eedly') THEN CASE WHEN length(b) >= r1 THEN b || 'ee' ELSE w END
            WHEN NOT regexp_matches(b, '[aeiouy]') THEN w
            WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
            WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(b, length(b) - 1)
            WHEN length(b) <= r1 AND regexp_matches(b, '{stems.SHORT_END}') THEN b || 'e' ELSE b END AS w
            FROM (SELECT *, {BASE} AS b FROM (SELECT *, {_ending(('eedly', 'ingly', 'edly', 'eed', 'ing', 'ed'))} AS s FROM st_0)))""",
        step("st_1c", "st_1", (), r"regexp_replace(w, '(.[^aeiouy])[yY]$', '\1i')"),
        step("st_2", "st_1c", stems.STEP_2, f"""CASE WHEN {IN_R1} AND (s <> 'ogi' OR {BASE} LIKE '%l')
            AND (s <> 'li' OR regexp_matches({BASE}, '[cdeghkmnrt]$')) THEN {BASE} || {_case('s', stems.STEP_2)} ELSE w END"""),
        step("st_3", "st_2", stems.STEP_3, f"CASE WHEN {IN_R1} AND (s <> 'ative' OR length(w) - 5 >= r2) THEN {BASE} || {_case('s', stems.STEP_3)} ELSE w END"),
        step("st_4", "st_3", stems.STEP_4, f"CASE WHEN {IN_R2} AND (s <> 'ion' OR regexp_matches({BASE}, '[st]$')) THEN {BASE} ELSE w END"),
        step("st_5", "st_4", (), f"""CASE WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1
            AND NOT regexp_matches(left(w, length(w) - 1), '{stems.SHORT_END}'))) THEN left(w, length(w) - 1)
            WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN left(w, length(w) - 1) ELSE w END"""),
        f"""stems AS (SELECT term, CASE WHEN length(term) <= 2 THEN term
            ELSE CASE term {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in stems.EXCEPTIONS.items())} ELSE replace(w, 'Y', 'y') END END AS stem FROM st_5)""",
    ]
    return ",\n        ".join(parts)
