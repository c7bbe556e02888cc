"""The value functions as SQL for comparison, from the same fixed values."""

from __future__ import annotations

from ..functions import rules as r
from ..functions import taxonomy as tax
from ..functions import values as v

_ROUNDS = 8


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sanitize(kind: str, value: str, text: str) -> str:
    def once(k: str, x: str) -> str:
        for p in v.PREFIXES[k]:
            x = f"regexp_replace({x}, {_q('(?i)' + p)}, '')"
        return f"trim({x}, {_q(v.STRIPPED)})"

    whens = " ".join(
        f"WHEN {_q(k)} THEN list_reduce(list_concat([{value}], list_transform(range({_ROUNDS}), lambda i: '')), lambda acc, x: {once(k, 'acc')})" for k in v.PREFIXES
    )
    clean = f"(CASE {kind} {whens} ELSE {value} END)"
    return f"(SELECT CASE WHEN length(c) > 0 AND contains({text}, c) THEN c ELSE {value} END FROM (SELECT {clean} AS c))"


def migrated(kind: str, value: str, text: str) -> str:
    left = f"lower(substring({text}, greatest(1, strpos({text}, {value}) - {v.KEYWORD_WINDOW}), least({v.KEYWORD_WINDOW}, strpos({text}, {value}) - 1)))"
    t = f"trim({value})"
    number = f"(regexp_full_match({t}, {_q(v.CNPJ + '|' + v.NUMBER)}) AND NOT regexp_matches({t}, '\\s|\\p{{L}}') AND len(regexp_extract_all({t}, '\\p{{Nd}}')) >= 6)"
    keyword = (
        f"(contains({left}, 'cnpj') OR contains({left}, 'inscri') AND (contains({left}, 'estadual') OR contains({left}, 'municipal')) "
        f"OR regexp_matches({left}, {_q(v.KEYWORD_INITIALS.format('e'))}) OR regexp_matches({left}, {_q(v.KEYWORD_INITIALS.format('m'))}))"
    )
    return f"(CASE WHEN {kind} IN ({', '.join(map(_q, v.MIGRATING))}) AND contains({text}, {value}) AND {number} AND {keyword} THEN 'DOC_EMPRESA' ELSE {kind} END)"


def _any(x: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, {_q(p)})" for p in parts) + ")"


def _starts(x: str, parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {_q(p)})" for p in parts) + ")"


def _in(x: str, parts: tuple[str, ...]) -> str:
    return f"{x} IN ({', '.join(map(_q, parts))})"


def _rules(kind: str, x: str) -> list[tuple[str, str]]:
    low, d, n, words = f"lower({x})", f"len(regexp_extract_all({x}, '\\p{{Nd}}'))", f"len(regexp_extract_all({x}, '\\p{{L}}'))", f"len(regexp_extract_all({x}, '[^\\x20\\x09-\\x0D]+'))"
    sep, mail = f"regexp_matches({x}, '[-./]')", f"contains({x}, '@')"
    if kind == "CONTATO":
        return [
            (f"{mail} AND regexp_matches({x}, '\\s')", "mail_space"), (f"{mail} AND length({x}) - length(replace({x}, '@', '')) > 1", "mail_at"),
            (f"{mail} AND NOT contains(split_part({x}, '@', 2), '.')", "mail_domain"), (f"{mail} AND contains({_q(r.MAIL_TAIL)}, right({x}, 1))", "mail_tail"), (f"NOT {mail} AND {d} < 8", "phone_digits"),
        ]
    if kind == "DATA_NASC":
        return [(f"NOT regexp_matches({x}, {_q(r.BEFORE_WORD + r.BIRTH_DATE + r.AFTER_WORD)})", "no_date")]
    if kind == "ID_PROCESSUAL":
        return [(_starts(low, r.PROCESS_VERBOSE), "verbose"), (f"NOT ({d} >= 4 OR {d} >= 2 AND ({sep} OR {n} >= 2))", "digits")]
    if kind == "ID_VEICULO":
        return [(f"NOT (regexp_full_match({x}, {_q(r.PLATES)}) OR {d} IN (9, 10, 11))", "no_plate")]
    if kind == "DOC_PROFISSIONAL":
        return [(f"{d} < 3", "digits")]
    if kind == "DOC_EMPRESA":
        return [(f"{d} < 6", "digits"), (f"regexp_matches({x}, '\\s')", "space"), (f"{n} > 0", "letters"), (f"NOT regexp_full_match({x}, {_q(v.CNPJ + '|' + v.NUMBER)})", "shape")]
    if kind == "DADO_FINANCEIRO":
        return [(_starts(low, r.FINANCE_VERBOSE), "verbose"), (f"NOT {mail} AND ({d} < 4 OR {d} < 6 AND NOT {sep} AND {n} = 0)", "digits")]
    if kind == "DOC_PESSOAL":
        return [(f"{d} < 4", "digits"), (_any(low, r.PERSONAL_ADJECTIVES), "adjective"), (_any(low, r.PERSONAL_PREFIXES), "prefix")]
    if kind == "ORG_JURIDICA":
        acronym = f"({x} = upper({x}) AND {n} >= 2 AND length({x}) <= 18 AND NOT contains({x}, ' '))"
        single = f"({words} = 1 AND {n} >= 2)"
        return [
            (_in(low, r.ORG_GENERIC), "generic"), (f"contains({low}, 'cnpj')", "cnpj"), (f"regexp_full_match({x}, {_q(v.CNPJ)})", "number"), (f"{d} >= 6 AND {n} = 0", "number"),
            (f"regexp_matches({low}, {_q(f'{r.BEFORE_WORD}(?:{r.ORG_TITLES}){r.AFTER_WORD}')})", "title"),
            (f"({acronym} OR {single}) AND {_in(low, r.ORG_NOT_ACRONYM)}", "acronym"), (f"({acronym} OR {single}) AND {_in(low, r.ORG_SURNAMES)}", "surname"),
            (f"NOT ({single} OR {acronym} OR {words} >= 2 AND {n} >= 2 OR regexp_full_match({x}, {_q(r.NUMBERED_ORG)}))", "implausible"),
        ]
    if kind == "ENDERECO":
        return [(f"{d} = 0", "no_number"), (f"NOT regexp_matches({low}, {_q(f'{r.BEFORE_WORD}(?:{r.ADDRESS_MARKERS})')})", "no_marker")]
    if kind == "DADO_SAUDE":
        return [(_in(f"trim({low})", r.HEALTH_GENERIC), "generic")]
    if kind == "NOME_PESSOA":
        return [(f"{d} > 0", "digits"), (f"{_any(low, r.NAME_TITLES)} AND {words} <= 2", "title")]
    return [(f"{words} < 3", "words"), (f"length({x}) < 15", "short")]


def _common(x: str) -> str:
    return (
        f"WHEN {x} IS NULL OR {x} = '' THEN 'empty' WHEN regexp_matches({x}, '^\\s|\\s$') THEN 'untrimmed' "
        f"WHEN contains({x}, chr(10)) OR contains({x}, chr(13)) THEN 'newline' WHEN length({x}) > {r.LONGEST} THEN 'too_long' "
    )


def error(kind: str, x: str) -> str:
    return "CASE " + _common(x) + " ".join(f"WHEN {c} THEN {_q(code)}" for c, code in _rules(kind, x)) + " END"


def error_any(kind: str, x: str) -> str:
    own = " ".join(f"WHEN {kind} = {_q(k)} AND ({c}) THEN {_q(code)}" for k in tax.TYPES for c, code in _rules(k, x))
    return f"CASE WHEN {kind} IS NULL OR {kind} NOT IN ({', '.join(map(_q, tax.TYPES))}) THEN 'unknown_type' " + _common(x) + own + " END"
