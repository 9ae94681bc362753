"""SQL text for the string rules, in the dialect of the checking engine.

That engine's patterns know neither look-around nor class intersection, so the
rules are written a second time rather than translated.
"""

import re

from siftloom import constants as C
from siftloom.functions.text import WHITESPACE

WS = (r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS_NO_LF = WS.replace(r"\t-\r", r"\t\x0b-\r")
LB = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0b\f\r]"
WORD_CHARS = r"\p{L}\p{N}_"


def quote(text: str) -> str:
    """A string literal; characters outside printable ASCII are spelled with chr()."""
    parts = re.findall(r"[ -~]+|[^ -~]", text)
    spelled = ["'" + p.replace("'", "''") + "'" if " " <= p[0] <= "~" else f"chr({ord(p)})"
               for p in parts]
    return "(" + " || ".join(spelled) + ")" if spelled else "''"


def pick(values, index: str) -> str:
    return f"list_extract([{', '.join(quote(v) for v in values)}], CAST({index} AS BIGINT) + 1)"


def names(values) -> str:
    return ", ".join(quote(v) for v in values)


def strip(x: str) -> str:
    return f"trim({x}, {quote(WHITESPACE)})"


def lower_strip(x: str) -> str:
    return strip(f"lower(coalesce({x}, ''))")


def clean(x: str) -> str:
    unix = rf"regexp_replace(coalesce({x}, ''), '\r\n?', chr(10), 'g')"
    trimmed = rf"regexp_replace({unix}, '[{WS_NO_LF}]+(\n|\z)', '\1', 'g')"
    return strip(rf"regexp_replace({trimmed}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def lines(x: str) -> str:
    return (f"CASE WHEN {x} = '' THEN [] ELSE string_split_regex("
            rf"regexp_replace({x}, '(?:\r\n|[{LB}])\z', ''), '\r\n|[{LB}]') END")


def words(x: str) -> str:
    return (f"CASE WHEN {strip(x)} = '' THEN [] ELSE "
            f"string_split_regex({strip(x)}, '[{WS}]+') END")


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{TOKEN}'))"


def case_of(x: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in table.items())
    return f"CASE {x} {arms} ELSE {default} END"


def filter_language(x: str) -> str:
    return case_of(lower_strip(x), C.FILTER_LANGUAGE_ALIASES, lower_strip(x))


def normalize_license(x: str) -> str:
    return case_of(lower_strip(x), C.LICENSE_ALIASES, lower_strip(x))


def normalize_language(x: str) -> str:
    known = {name: name for name in C.SUPPORTED_LANGUAGES}
    return case_of(lower_strip(x), {**C.DETECTOR_LANGUAGE_ALIASES, **known}, "'unknown'")


def difficulty(x: str) -> str:
    return case_of(lower_strip(x), {d: d for d in C.DIFFICULTIES}, "'unknown'")


def quality(x: str) -> dict:
    """The quality findings of a text column."""
    split = f"({lines(x)})"
    kept = f"[{strip('l')} FOR l IN {split} IF {strip('l')} <> '']"
    notice = " OR ".join(f"contains(lower({x}), {quote(p)})" for p in C.AUTOGENERATED_PHRASES)
    return {
        "autogenerated": f"({notice})",
        "suspicious": rf"regexp_matches({x}, '[\x00-\x08\x0B\x0C\x0E-\x1F]')",
        "minified": (f"((len({split}) <= 2 AND length({x}) > 2000) OR "
                     f"coalesce(list_sum([length(l) FOR l IN {split}]), 0) "
                     f"/ greatest(len({split}), 1) > 400)"),
        "repetitive": (f"(len({kept}) >= 10 AND "
                       f"len(list_distinct({kept})) / len({kept}) < 0.30)"),
    }


def shebang(x: str) -> str:
    first = f"lower(split_part({x}, chr(10), 1))"
    arms = " ".join(
        f"WHEN {' OR '.join(f'contains({first}, {quote(f)})' for f in fragments)} "
        f"THEN {quote(language)}" for fragments, language in C.SHEBANG_LANGUAGES)
    return f"CASE WHEN starts_with({first}, '#!') THEN CASE {arms} END END"


def extension(x: str) -> str:
    arms = " ".join(f"WHEN ends_with(lower({x}), {quote('.' + ext)}) THEN {quote(language)}"
                    for ext, language in C.EXTENSION_LANGUAGES.items())
    return f"CASE {arms} END"


def _pattern(pattern: str) -> str:
    body = pattern.replace(r"[\w-]", f"[{WORD_CHARS}-]").replace(r"\w", f"[{WORD_CHARS}]")
    body = body.replace(r"\s", f"[{WS}]").replace(r"\b", rf"(?:[^{WORD_CHARS}]|\z)")
    return "'" + "(?im-s)" + re.sub(r"\{$", r"\\{", body).replace("'", "''") + "'"


def scores(x: str, lowered: str) -> list[tuple[str, str]]:
    """(language, score expression) in list order."""
    return [(language, " + ".join(
        [f"CASE WHEN contains({lowered}, {quote(k)}) THEN 2 ELSE 0 END" for k in keywords]
        + [f"CASE WHEN regexp_matches({x}, {_pattern(p)}) THEN 3 ELSE 0 END" for p in patterns]))
        for language, keywords, patterns in C.LANGUAGE_EVIDENCE]


def keyword_ctes(source: str, key: str, code: str) -> str:
    """CTEs `scored` (one column per language) and `best` (key, keyword_language)."""
    columns = scores(code, "lowered")
    select = ", ".join(f"{expr} AS s{i}" for i, (_, expr) in enumerate(columns))
    top = "greatest(" + ", ".join(f"s{i}" for i in range(len(columns))) + ")"
    arms = " ".join(f"WHEN s{i} = top THEN {quote(language)}"
                    for i, (language, _) in enumerate(columns))
    return (f"lowered_code AS MATERIALIZED (SELECT {key}, {code}, lower({code}) AS lowered "
            f"FROM {source}), "
            f"scored AS MATERIALIZED (SELECT {key}, {select} FROM lowered_code), "
            f"topped AS (SELECT *, {top} AS top FROM scored), "
            f"best AS (SELECT {key}, CASE WHEN top = 0 THEN NULL {arms} END AS keyword_language "
            f"FROM topped)")


def detected(code: str, filename: str = None, hint: str = None) -> str:
    """Detection order over a row that already has `keyword_language`."""
    tried = [shebang(code)]
    if filename:
        tried.append(extension(filename))
    tried.append(f"CASE WHEN length({code}) > 20 THEN keyword_language END")
    if hint:
        tried.append(f"CASE WHEN {lower_strip(hint)} IN ({names(C.SUPPORTED_LANGUAGES)}) "
                     f"THEN {lower_strip(hint)} END")
    return f"coalesce({', '.join(tried)}, 'unknown')"
