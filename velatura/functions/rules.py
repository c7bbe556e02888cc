"""Format rules of entity values, one error code (or null) per value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .taxonomy import TYPES
from .text import digits, letters, word_count
from .values import CNPJ, NUMBER

# Words that are no organisations.
ORG_NOT_ACRONYM = ("gps", "pdf", "csv", "cid", "ppp", "ctps", "ipva", "gta", "sei", "sisreg")
ORG_SURNAMES = (
    "silva", "souza", "sousa", "oliveira", "santos", "pereira", "ferreira", "rodrigues", "albuquerque", "alencar", "viana", "meireles",
    "mendonça", "mendonca", "camargo", "holanda", "arruda", "castro", "medeiros", "magalhães", "magalhaes",
)
ORG_GENERIC = (
    "urgente", "obrigado", "obrigada", "desde", "muito", "preciso", "quero", "saber", "solicito", "detalhadas", "reforma", "portal",
    "transporte", "animais", "profissionais", "pagamento", "deste", "regional",
)
ORG_TITLES = (
    r"secret[aá]rio|diretor|presidente|procurador|delegado|ju[ií]z|desembargador|governador|prefeito|vereador|senador|deputado|ministro|"
    r"sr\.?|sra\.?|dr\.?|dra\.?|ilustr[ií]ssimo|ilustrissima|senhor|senhora"
)
# Beginnings, parts and forms that the other rules name.
PROCESS_VERBOSE = ("processo", "sei ", "sei-", "protocolo", "edital", "portaria", "boletim", "auto de", "matrícula", "inscrição", "nº ", "n° ", "n. ")
FINANCE_VERBOSE = ("agência", "agencia", "ag.", "conta", "chave pix", "pix:", "pix ", "banco do brasil", "banco itaú")
PERSONAL_ADJECTIVES = ("digital", "novo", "novos", "segunda via", "2a via", "2ª via")
PERSONAL_PREFIXES = ("cpf:", "rg:", "cnh:", "pis:", "pasep:", "nit:")
HEALTH_GENERIC = ("laudo", "atestado", "prontuário", "prontuario")
NAME_TITLES = (" sr", " sra", " dr", " dra", "senhor", "senhora")
MAIL_TAIL = ".,;:)]"
BIRTH_DATE = r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"
PLATES = r"[A-Z]{3}-?\d{4}|[A-Z]{3}-?\d[A-Z]\d{2}"
NUMBERED_ORG = r"\d+[ªº]?\s*[A-Za-z]{2,}"
ADDRESS_MARKERS = (
    r"rua|r\.|avenida|av\.|alameda|travessa|quadra|qd|q\.d\.|bloco|bl|lote|lt|conjunto|conj|setor|cep|sqs|sqn|shdf|sh|crn|cln|l3|eixo|apto|"
    r"apartamento|estrada|rodovia|br-|mg-|sp-|go-|df-|pr-|rj-|ba-|rs-|sc-|mt-|ms-|pa-|am-|ce-|pe-|ma-|fazenda|sítio|sitio|chácara|chacara|gleba|"
    r"núcleo rural|nucleo rural|assentamento|km"
)
LONGEST = 220

#: Edges of a word, spelled out: engines differ in what \b does beside accents.
BEFORE_WORD, AFTER_WORD = r"(?:^|[^\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)"


def _any(v: Column, parts: tuple[str, ...]) -> Column:
    out = v.contains(parts[0])
    for p in parts[1:]:
        out |= v.contains(p)
    return out


def _starts(v: Column, parts: tuple[str, ...]) -> Column:
    out = v.startswith(parts[0])
    for p in parts[1:]:
        out |= v.startswith(p)
    return out


def _ends(v: Column, chars: str) -> Column:
    return F.call_function("instr", F.lit(chars), F.right(v, F.lit(1))) > 0


def _all(v: Column, form: str) -> Column:
    """The whole of ``v`` has the form."""
    return v.rlike(rf"^(?:{form})\z")


def _common(kind: Column, v: Column) -> list[tuple[Column, str]]:
    return [
        (~kind.isin(*TYPES) | kind.isNull(), "unknown_type"),
        (v.isNull() | (v == ""), "empty"),
        (v.rlike(r"^(?U:\s)|(?U:\s)\z"), "untrimmed"),
        (v.contains("\n") | v.contains("\r"), "newline"),
        (F.length(v) > LONGEST, "too_long"),
    ]


def _rules(kind: str, v: Column) -> list[tuple[Column, str]]:
    """(condition, code): the first condition that holds names the error."""
    low, d, n = F.lower(v), digits(v), letters(v)
    separated = v.rlike(r"[\-./]")
    if kind == "CONTATO":
        mail = v.contains("@")
        return [
            (mail & v.rlike(r"(?U)\s"), "mail_space"),
            (mail & (F.regexp_count(v, F.lit("@")) > 1), "mail_at"),
            (mail & ~F.substring_index(v, "@", -1).contains("."), "mail_domain"),
            (mail & _ends(v, MAIL_TAIL), "mail_tail"),
            (~mail & (d < 8), "phone_digits"),
        ]
    if kind == "DATA_NASC":
        return [(~v.rlike(BEFORE_WORD + BIRTH_DATE + AFTER_WORD), "no_date")]
    if kind == "ID_PROCESSUAL":
        return [(_starts(low, PROCESS_VERBOSE), "verbose"), (~((d >= 4) | (d >= 2) & (separated | (n >= 2))), "digits")]
    if kind == "ID_VEICULO":
        return [(~(_all(v, PLATES) | d.isin(9, 10, 11)), "no_plate")]
    if kind == "DOC_PROFISSIONAL":
        return [(d < 3, "digits")]
    if kind == "DOC_EMPRESA":
        return [(d < 6, "digits"), (v.rlike(r"(?U)\s"), "space"), (n > 0, "letters"), (~_all(v, f"{CNPJ}|{NUMBER}"), "shape")]
    if kind == "DADO_FINANCEIRO":
        return [(_starts(low, FINANCE_VERBOSE), "verbose"), (~v.contains("@") & ((d < 4) | (d < 6) & ~separated & (n == 0)), "digits")]
    if kind == "DOC_PESSOAL":
        return [(d < 4, "digits"), (_any(low, PERSONAL_ADJECTIVES), "adjective"), (_any(low, PERSONAL_PREFIXES), "prefix")]
    if kind == "ORG_JURIDICA":
        many = word_count(v)
        acronym = (v == F.upper(v)) & (n >= 2) & (F.length(v) <= 18) & ~v.contains(" ")
        single = (many == 1) & (n >= 2)
        return [
            (low.isin(*ORG_GENERIC), "generic"), (low.contains("cnpj"), "cnpj"), (_all(v, CNPJ), "number"), ((d >= 6) & (n == 0), "number"),
            (low.rlike(f"{BEFORE_WORD}(?:{ORG_TITLES}){AFTER_WORD}"), "title"),
            ((acronym | single) & low.isin(*ORG_NOT_ACRONYM), "acronym"), ((acronym | single) & low.isin(*ORG_SURNAMES), "surname"),
            (~(single | acronym | (many >= 2) & (n >= 2) | _all(v, NUMBERED_ORG)), "implausible"),
        ]
    if kind == "ENDERECO":
        return [(d == 0, "no_number"), (~low.rlike(f"{BEFORE_WORD}(?:{ADDRESS_MARKERS})"), "no_marker")]
    if kind == "DADO_SAUDE":
        return [(F.btrim(low).isin(*HEALTH_GENERIC), "generic")]
    if kind == "NOME_PESSOA":
        return [(d > 0, "digits"), (_any(low, NAME_TITLES) & (word_count(v) <= 2), "title")]
    return [(word_count(v) < 3, "words"), (F.length(v) < 15, "short")]


def format_error(kind: Column | str, value: Column) -> Column:
    """The code of the first rule that the value breaks, null if it breaks none."""
    own = F.lit(kind) if isinstance(kind, str) else kind
    chain = F
    for cond, code in _common(own, value):
        chain = chain.when(cond, code)
    for k in TYPES if not isinstance(kind, str) else [kind] * (kind in TYPES):
        for cond, code in _rules(k, value):
            chain = chain.when((own == k) & cond, code)
    return chain.otherwise(F.lit(None).cast("string"))
