"""The label space: entity types, personal types, BIO labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entity types in label order, and those that are not personal.
TYPES = (
    "NOME_PESSOA", "DOC_PESSOAL", "DATA_NASC", "CONTATO", "ENDERECO", "DOC_PROFISSIONAL", "ID_PROCESSUAL", "ID_VEICULO", "ORG_JURIDICA",
    "DADO_SAUDE", "DADO_FINANCEIRO", "DOC_EMPRESA", "QUASI_IDENTIFICADOR",
)
NON_PII_TYPES = ("ORG_JURIDICA", "DOC_EMPRESA")
PII_TYPES = tuple(t for t in TYPES if t not in NON_PII_TYPES)

# Order of precedence of the types (declared, not used by any operator).
PRIORITY = (
    "DOC_PESSOAL", "DOC_PROFISSIONAL", "DOC_EMPRESA", "CONTATO", "DATA_NASC", "ENDERECO", "NOME_PESSOA", "DADO_FINANCEIRO", "ID_PROCESSUAL",
    "ID_VEICULO", "DADO_SAUDE", "ORG_JURIDICA", "QUASI_IDENTIFICADOR",
)
if set(PRIORITY) != set(TYPES):
    raise RuntimeError(f"types without precedence: {sorted(set(TYPES) ^ set(PRIORITY))}")

LABELS = ("O", *(f"{p}-{t}" for t in TYPES for p in "BI"))
IGNORED = -100  # label of tokens that stand for no text


def label_maps(label2id: dict | None = None, id2label: dict | None = None) -> tuple[dict[str, int], dict[int, str]]:
    """A model's own maps where it has both, with keys of the right kind; else those of ``LABELS``."""
    if label2id and id2label:
        return {str(k): int(v) for k, v in label2id.items()}, {int(k): str(v) for k, v in id2label.items()}
    return {x: i for i, x in enumerate(LABELS)}, dict(enumerate(LABELS))


def id_to_label(i: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The label of an id; O for ids out of range."""
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, labels)), F.when(i >= 0, i + 1).cast("int")), F.lit("O"))


def label_to_id(label: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The id of a label, null for one that is not listed."""
    at = F.array_position(F.array(*map(F.lit, labels)), label)
    return F.when(at > 0, (at - 1).cast("int"))


def is_pii(kind: Column) -> Column:
    return kind.isin(*PII_TYPES)


def is_bio(label: Column) -> Column:
    """O, or B or I with a type."""
    return label.rlike(r"(?s)^(O|[BI]-.+)\z")


def bio_prefix(label: Column) -> Column:
    """B or I; O for O and for labels that are not BIO labels."""
    return F.when(is_bio(label), F.substring(label, 1, 1)).otherwise("O")


def bio_type(label: Column) -> Column:
    """The type of a B or I label; null for all others."""
    return F.when(is_bio(label) & (label != "O"), F.split(label, "-", 2)[1])
