"""Entity values: stripping label prefixes, company identifiers, the canonical form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import digits, let

# Per type the prefixes that are stripped from a value, in order; upper and lower case alike.
PREFIXES: dict[str, tuple[str, ...]] = {
    "ID_PROCESSUAL": (
        r"^processo(?:\s+sei)?(?:\s+n[º°.]*)?\s*",
        r"^sei(?:\s+n[º°.]*)?\s*",
        r"^protocolo(?:\s+n[º°.]*)?\s*",
        r"^edital(?:\s+n[º°.]*)?\s*",
        r"^portaria(?:\s+n[º°.]*)?\s*",
        r"^boletim(?:\s+de\s+ocorrência)?(?:\s+n[º°.]*)?\s*",
        r"^auto(?:\s+de\s+infração)?(?:\s+n[º°.]*)?\s*",
        r"^matrícula(?:\s+n[º°.]*)?\s*",
        r"^inscrição(?:\s+imobiliária)?(?:\s+n[º°.]*)?\s*",
        r"^n[º°.]+\s*",
    ),
    "DOC_PROFISSIONAL": (
        r"^matrícula(?:\s+n[º°.]*)?\s*",
        r"^mat\.?\s*",
        r"^rgp(?:\s+n[º°.]*)?\s*",
        r"^registro(?:\s+profissional)?(?:\s+n[º°.]*)?\s*",
        r"^inscrição(?:\s+n[º°.]*)?\s*",
    ),
    "DADO_FINANCEIRO": (
        r"^agência\s*",
        r"^agencia\s*",
        r"^ag\.\s*",
        r"^conta(?:\s+corrente|\s+poupança)?(?:\s+n[º°.]*)?\s*",
        r"^chave(?:\s+pix)?(?::)?\s*",
        r"^pix(?::)?\s*",
        r"^banco(?:\s+do\s+brasil|\s+itaú)?\s+(?:agência|ag\.?)\s*",
    ),
    "ID_VEICULO": (r"^placa(?::)?\s*", r"^renavam(?::)?\s*", r"^chassi(?::)?\s*"),
    "DOC_PESSOAL": (r"^cpf(?::)?\s*", r"^rg(?::)?\s*", r"^cnh(?::)?\s*", r"^título(?:\s+de\s+eleitor)?(?::)?\s*"),
    "DOC_EMPRESA": (
        r"^cnpj(?::)?\s*",
        r"^inscri[cç][aã]o\s+estadual(?::)?\s*",
        r"^inscri[cç][aã]o\s+municipal(?::)?\s*",
        r"^i[.\s-]*e[.\s-]*(?::)?\s*",
        r"^i[.\s-]*m[.\s-]*(?::)?\s*",
        r"^isento(?::)?\s*",
    ),
    "CONTATO": (r"^tel(?:efone)?(?::)?\s*", r"^cel(?:ular)?(?::)?\s*", r"^e-?mail(?::)?\s*", r"^whatsapp(?::)?\s*"),
    "ORG_JURIDICA": (r"^raz[aã]o\s+social(?::)?\s*", r"^empresa(?::)?\s*", r"^órg[aã]o(?::)?\s*", r"^org[aã]o(?::)?\s*"),
}
STRIPPED = " :.-,"
# Forms of company identifiers, and of their keywords in what stands before.
CNPJ = r"\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}"
NUMBER = r"[0-9][0-9.\-/]{5,}"
KEYWORD_INITIALS = r"(?:^|[^a-z])i\.?\s*{}\.?(?:[^a-z]|$)"
KEYWORD_WINDOW = 40
MIGRATING = ("ORG_JURIDICA", "ID_PROCESSUAL")


def _round(kind: str, value: Column) -> Column:
    for p in PREFIXES[kind]:
        value = F.regexp_replace(value, F.lit("(?iU)" + p), F.lit(""))
    return F.btrim(value, F.lit(STRIPPED))


def _fixpoint(kind: str, value: Column) -> Column:
    """Rounds of stripping until nothing changes.

    A round that changes anything makes the value shorter, so there are at most as many as it has characters;
    after the last one that did the others are skipped.
    """
    start = F.struct(value.alias("v"), F.lit(False).alias("done"))

    def step(acc: Column, _: Column) -> Column:
        return F.when(acc["done"], acc).otherwise(let(_round(kind, acc["v"]), lambda new: F.struct(new.alias("v"), (new == acc["v"]).alias("done"))))

    rounds = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(value)))
    return F.aggregate(rounds, start, step, lambda acc: acc["v"])


def sanitize(kind: Column, value: Column, text: Column) -> Column:
    """The value without label prefixes, if something is left of it that the text holds; else the value itself."""
    clean = F.when(kind.isNull(), value)
    for k in PREFIXES:
        clean = clean.when(kind == k, _fixpoint(k, value))
    return let(clean.otherwise(value), lambda out: F.when((F.length(out) > 0) & text.contains(out), out).otherwise(value))


def is_company_number(value: Column) -> Column:
    v = F.btrim(value)
    shape = v.rlike(rf"^(?:{CNPJ}|{NUMBER})\z")
    return shape & ~v.rlike(r"(?U)\s|\p{L}") & (digits(v) >= 6)


def has_company_keyword(text: Column, value: Column, window: int = KEYWORD_WINDOW) -> Column:
    """Whether a company keyword stands within ``window`` characters before the first occurrence of ``value``."""
    at = F.call_function("instr", text, value)
    before = F.lower(F.substring(text, F.greatest(F.lit(1), at - window), F.least(F.lit(window), at - 1)))

    def named(left: Column) -> Column:
        by_name = left.contains("cnpj") | left.contains("inscri") & (left.contains("estadual") | left.contains("municipal"))
        return by_name | left.rlike(KEYWORD_INITIALS.format("e")) | left.rlike(KEYWORD_INITIALS.format("m"))

    return (at > 0) & let(before, named)


def migrated_type(kind: Column, value: Column, text: Column) -> Column:
    """DOC_EMPRESA for company numbers under a company keyword that were labelled as an organisation or a process."""
    moves = kind.isin(*MIGRATING) & is_company_number(value) & text.contains(value) & has_company_keyword(text, value)
    return F.when(moves, F.lit("DOC_EMPRESA")).otherwise(kind)


def canonical(kind: Column, value: Column, text: Column, normalize: bool = True, migrate: bool = False) -> tuple[Column, Column]:
    """(type, value) of an entity in canonical form: stripped, migrated (only inside ``normalize``), stripped under its new type."""
    if not normalize:
        return kind, value
    if not migrate:
        return kind, sanitize(kind, value, text)

    def moved(v: Column) -> Column:
        return let(migrated_type(kind, v, text), lambda t: F.struct(t.alias("type"), sanitize(t, v, text).alias("value")))

    both = let(sanitize(kind, value, text), moved)
    return both["type"], both["value"]


def gold_form(kind: Column, value: Column, text: Column) -> Column:
    """struct(type, value) as gold spans take it: stripped, for migrating types also of company prefixes, and migrated."""

    def company(v: Column) -> Column:
        return F.when(kind.isin(*MIGRATING), sanitize(F.lit("DOC_EMPRESA"), v, text)).otherwise(v)

    stripped = let(sanitize(kind, value, text), company)
    return let(stripped, lambda v: F.struct(migrated_type(kind, v, text).alias("type"), v.alias("value")))
