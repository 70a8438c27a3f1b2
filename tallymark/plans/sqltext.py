"""Pieces of the comparison SQL, written against the views and not against our operators."""

from __future__ import annotations

from ..functions.strings import WHITE_SPACE

_SPACE_CHARS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def strip(x: str) -> str:
    return f"trim({x}, {_SPACE_CHARS})"


def first_number(x: str) -> str:
    return f"try_cast(regexp_extract(regexp_replace({x}, '[%,]', '', 'g'), '(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE)"


def safe_int(x: str) -> str:
    return f"coalesce(try_cast(trunc({first_number(x)}) AS BIGINT), 0)"


def whole_number(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({x}), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
        f"AND isfinite(coalesce(try_cast(trim({x}) AS DOUBLE), 0.0)) THEN try_cast(trim({x}) AS DOUBLE) END"
    )


def clean_rate(x: str) -> str:
    percent = whole_number(f"replace(replace({x}, '%', ''), ',', '')")
    bare = whole_number(f"replace({x}, ',', '')")
    return (
        f"coalesce(CASE WHEN ends_with(trim({x}), '%') THEN {percent} "
        f"WHEN {bare} > 0 AND {bare} < 1 THEN round_even({bare} * 100.0, 6) "
        f"ELSE round_even({bare}, 6) END, 0.0)"
    )


def percent(part: str, whole: str, scale: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN round_even(({part}) / {whole} * 100.0, {scale}) ELSE 0.0 END"


def engagement(whole: str = "impressions") -> str:
    return f"least({percent('likes + comments + shares + clicks', whole, 6)}, 100.0)"


def has_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def post_type(raw: str, text: str) -> str:
    """``raw`` and ``text`` are columns in lower case; ``raw`` trimmed and not a distribution word."""
    return f"""CASE
      WHEN contains({raw}, 'video') OR contains({text}, 'video') THEN 'video'
      WHEN {has_any(raw, ['image', 'photo', 'picture'])}
        OR {has_any(text, ['image', 'photo', 'picture', 'jpg', 'jpeg', 'png'])} THEN 'image'
      WHEN {has_any(raw, ['document', 'pdf', 'doc'])}
        OR {has_any(text, ['document', 'pdf', '.ppt', '.pptx', '.doc', '.docx', '.slideshare'])} THEN 'document'
      WHEN {has_any(raw, ['article', 'link'])} OR contains({text}, '/pulse/') THEN 'article'
      WHEN {has_any(raw, ['text', 'status'])} THEN 'text'
      WHEN contains({text}, 'http') THEN 'article' ELSE 'text' END"""


def undistributed(raw: str) -> str:
    return (
        f"CASE WHEN lower(trim(coalesce({raw}, ''))) IN ('organic', 'sponsored', 'paid', 'boosted', 'promoted') "
        f"THEN '' ELSE lower(trim(coalesce({raw}, ''))) END"
    )


def tags(text: str, sign: str) -> str:
    """Tags in order of first use, joined by a blank."""
    if sign == "#":
        found = f"regexp_extract_all(regexp_replace({text}, '&#', '& ', 'g'), '#([\\pL\\pN_]+)', 1)"
    else:
        found = f"regexp_extract_all({text}, '@([\\pL\\pN_.\\-]+)', 1)"
    distinct = f"list_filter({found}, lambda t, i: list_position({found}, t) = i)"
    return f"coalesce(array_to_string(list_transform({distinct}[1:50], lambda t: '{sign}' || t), ' '), '')"


def day_from_text(x: str, day_first: bool = False) -> str:
    """A timestamp at midnight from the spellings of dates without a time of day."""
    month_day = {"/": "%m/%d/%Y", "-": "%m-%d-%Y"}
    day_month = {"/": "%d/%m/%Y", "-": "%d-%m-%Y"}
    orders = [day_month, month_day] if day_first else [month_day, day_month]
    two_digit = (
        f"regexp_replace({x}, '(\\d{{2}})$', CASE WHEN try_cast(right({x}, 2) AS INT) >= 69 "
        f"THEN '19\\1' ELSE '20\\1' END)"
    )
    month_day["."], day_month["."] = "%m.%d.%Y", "%d.%m.%Y"
    x = f"regexp_replace(regexp_replace({x}, '^[A-Z][a-z]+, ', ''), '^Sept ', 'Sep ')"
    named_year = (
        f"regexp_replace({x}, ' (\\d{{2}})$', CASE WHEN try_cast(right({x}, 2) AS INT) >= 69 THEN ' 19\\1' ELSE ' 20\\1' END)"
    )
    cases = []
    for sep in "/-.":
        mark = "[.]" if sep == "." else sep
        formats = ", ".join(f"'{o[sep]}'" for o in orders)
        cases.append(f"WHEN regexp_matches({x}, '^\\d{{1,2}}{mark}\\d{{1,2}}{mark}\\d{{4}}$') THEN try_strptime({x}, [{formats}])")
        cases.append(
            f"WHEN regexp_matches({x}, '^\\d{{1,2}}{mark}\\d{{1,2}}{mark}\\d{{2}}$') THEN try_strptime({two_digit}, [{formats}])"
        )
    cases.append(f"WHEN regexp_matches({x}, '^\\d{{4}}[/-]\\d{{1,2}}[/-]\\d{{1,2}}$') THEN try_strptime({x}, ['%Y-%m-%d', '%Y/%m/%d'])")
    cases.append(
        f"WHEN regexp_matches({x}, '^[A-Za-z]+ \\d{{1,2}}, \\d{{4}}$') THEN try_strptime({x}, ['%B %d, %Y', '%b %d, %Y'])"
    )
    cases.append(
        f"WHEN regexp_matches({x}, '^\\d{{1,2}} [A-Za-z]+ \\d{{4}}$') THEN try_strptime({x}, ['%d %B %Y', '%d %b %Y'])"
    )
    cases.append(f"WHEN regexp_matches({x}, '^\\d{{1,2}} [A-Za-z]+ \\d{{2}}$') THEN try_strptime({named_year}, '%d %b %Y')")
    cases.append(f"WHEN regexp_matches({x}, '^\\d{{8}}$') THEN try_strptime({x}, '%Y%m%d')")
    return "CASE " + " ".join(cases) + " END"
