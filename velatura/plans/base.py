"""Tables that the queries start from, as DataFrames and as the same SQL: fixtures, tokens, rule spans, annotated documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy as tax
from ..functions.text import TOKEN
from ..operators import emit, tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


# (row_id, text, [(type, value)])
ANNOTATED: list[tuple[int, str, list[tuple[str, str]]]] = [
    (1, "O CPF do solicitante João Silva é 123.456.789-00.", [("NOME_PESSOA", "João Silva"), ("DOC_PESSOAL", "123.456.789-00")]),
    (2, "Encaminho o processo SEI 001.002.003/2024.", [("ID_PROCESSUAL", "001.002.003/2024")]),
    (3, "Solicito informações sobre a Lei 12.527/2011.", []),
    (4, "Meu nome é Maria da Silva e meu CPF é 987.654.321-00. Maria da Silva mora em Brasília.", [("NOME_PESSOA", "Maria da Silva"), ("DOC_PESSOAL", "987.654.321-00")]),
    (5, "CPF: 123.456.789-00, SEI nº 123456/2023", [("DOC_PESSOAL", "CPF: 123.456.789-00"), ("ID_PROCESSUAL", "SEI nº 123456/2023")]),
    (6, "Rua João Silva 10", [("NOME_PESSOA", "João Silva"), ("ENDERECO", "Rua João Silva 10")]),
    (7, "A empresa de CNPJ 25.598.301/0001-68 e a IMPRENSA NACIONAL", [("ORG_JURIDICA", "25.598.301/0001-68"), ("ORG_JURIDICA", "IMPRENSA NACIONAL")]),
    (8, "Inscrição estadual 110.042.490.114 da firma; protocolo 110.042.490.114", [("ID_PROCESSUAL", "110.042.490.114")]),
    (9, "aaaa aa", [("ORG_JURIDICA", "aa")]),
    (10, "Fale com ana@exemplo.com.br ou tel: (61) 99999-8888; ana@exemplo.com.br.", [("CONTATO", "ana@exemplo.com.br"), ("CONTATO", "tel: (61) 99999-8888")]),
    (11, "processo novo 12 | <b>R&D</b>\nEmpresa Brasileira de Correios", [("ID_PROCESSUAL", "processo novo 12"), ("ORG_JURIDICA", "Empresa Brasileira de Correios")]),
    (12, "Placa: ABC-1234 e matrícula nº 4455, chave pix: joao@x.org", [("ID_VEICULO", "Placa: ABC-1234"), ("DOC_PROFISSIONAL", "matrícula nº 4455"), ("DADO_FINANCEIRO", "chave pix: joao@x.org")]),
    (13, "CGU e CGU, Silva e Silva", [("ORG_JURIDICA", "CGU"), ("NOME_PESSOA", "Silva"), ("ORG_JURIDICA", "Silva")]),
    (14, "", []),
    (15, "Nascida em 01/02/1990, laudo de epilepsia, motorista da linha 805.6, no horário das 07h15", [("DATA_NASC", "01/02/1990"), ("DADO_SAUDE", "laudo de epilepsia"), ("QUASI_IDENTIFICADOR", "motorista da linha 805.6, no horário das 07h15")]),
]

#: (type, value, label_ord, value_ord)
REVIEW: list[tuple[str, str, int, int]] = [
    ("NOME_PESSOA", "João Silva", 0, 0), ("NOME_PESSOA", "Silva", 0, 1), ("DOC_PESSOAL", "123.456.789-00", 1, 0), ("CONTATO", "ana@exemplo.com.br", 2, 0),
    ("ORG_JURIDICA", "CGU", 3, 0), ("ORG_JURIDICA", "Silva", 3, 1), ("ORG_JURIDICA", "Brasileira de Correios", 3, 2),
]

#: Values that the format rules are tried on, besides words and phrases of the documents.
VALUES = [
    "129.180.122-6", "CPF", "123456/2023", "123456", "SEI nº 123456/2023", "ABC-1234", "ABC1D23", "placa ABC-1234", "25.598.301/0001-68", "110.042.490.114",
    "IE 123456", "12345-6", "email@x.com", "0850", "3456", "CGU", "DF LEGAL", "URGENTE", "GPS", "SILVA", "SECRETÁRIO DE ESTADO", "a@b.com", "(61) 99999-8888",
    "a@b", "a@b.com.", "1234567", "motorista da linha 805.6, no horário das 07h15", "linha 805.6", "01/02/1990", "1/2/90 ", "5ª DP", "laudo", "Laudo de CID",
    "Rua 7", "Sr João", "João da Silva Sauro Neto", "cpf: 1234", "12345678901", "nº 1234", "auto de 12", "Quadra sem numero", "QD 12", "RG novo 123456", "a b@c.d", "a@@b.c",
    "Sra. Dra", "Dr. Paulo 1", "banco itaú 99", "ag. 0001", "85-SES/DF", "PA-1", "CNPJ 1", "Detran", "x", "linha\nquebrada", "  espaço", "Magalhães", "MEDEIROS",
]


def text_literal(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _fixture_sql() -> str:
    rows = []
    for i, t, ents in ANNOTATED:
        items = ", ".join(f"{{'type': {text_literal(k)}, 'value': {text_literal(v)}}}" for k, v in ents)
        rows.append(f"(CAST({i} AS BIGINT), {text_literal(t)}, CAST([{items}] AS STRUCT(type VARCHAR, value VARCHAR)[]))")
    return "annotated(row_id, text, entities) AS (VALUES " + ",\n".join(rows) + ")"


FIXTURE_SQL = _fixture_sql()
REVIEW_SQL = "review(type, value, label_ord, value_ord) AS (VALUES " + ", ".join(f"({text_literal(t)}, {text_literal(v)}, {a}, {b})" for t, v, a, b in REVIEW) + ")"
LABELS_SQL = "[" + ", ".join(text_literal(x) for x in tax.LABELS) + "]"
PII_SQL = "(" + ", ".join(text_literal(x) for x in tax.PII_TYPES) + ")"
WS = r"[\x09-\x0D\x20]"
NWS = r"[^\x09-\x0D\x20]"


def annotated(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t, [{"type": k, "value": v} for k, v in e]) for i, t, e in ANNOTATED], "row_id long, text string, entities array<struct<type:string,value:string>>")


def review(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVIEW, "type string, value string, label_ord int, value_ord int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents, with the fixture's under negative ids ---------------------------------------------

DOCS_SQL = f"{FIXTURE_SQL},\ndocs AS (SELECT doc_id, text FROM documents UNION ALL SELECT -row_id, text FROM annotated)"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    mine = annotated(spark).select((-F.col("row_id")).alias("doc_id"), "text")
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(mine)


# --- entities: the first words of each document, overlapping on purpose, and all of its mail addresses and long numbers -------

_TWO = rf"^({NWS}+{WS}+{NWS}+)"
_THREE = rf"^({NWS}+{WS}+{NWS}+{WS}+{NWS}+)"
_NEXT = rf"^(?:{NWS}+{WS}+){{2}}({NWS}+{WS}+{NWS}+{WS}+{NWS}+)"
_ENTITIES = (
    ("NOME_PESSOA", _TWO, 1), ("ENDERECO", _THREE, 1), ("QUASI_IDENTIFICADOR", _NEXT, 1),
)
_EVERY = (("CONTATO", emit.RULES[0][1]), ("DADO_FINANCEIRO", emit.RULES[3][1]))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, text, entities) of all documents and the fixture."""
    text = F.coalesce("text", F.lit(""))
    listed = F.array(*[F.struct(F.lit(k).alias("type"), F.regexp_extract(text, form, g).alias("value")) for k, form, g in _ENTITIES])

    def every(kind: str, form: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(form), F.lit(0)), lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))

    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", F.filter(F.concat(listed, *(every(*e) for e in _EVERY)), lambda e: e["value"] != "").alias("entities"))
    mine = annotated(spark).withColumn("row_id", -F.col("row_id"))
    return own.unionByName(mine)


ENTITIES_SQL = f"""{FIXTURE_SQL},
ents AS (
  SELECT doc_id AS row_id, text, list_filter([{", ".join(f"{{'type': '{k}', 'value': regexp_extract(coalesce(text, ''), '{form}', {g})}}" for k, form, g in _ENTITIES)}]
    || {" || ".join(f"list_transform(regexp_extract_all(coalesce(text, ''), '{form}'), lambda v: {{'type': '{k}', 'value': v}})" for k, form in _EVERY)}, lambda e: e.value <> '') AS entities
  FROM documents UNION ALL SELECT -row_id, text, entities FROM annotated)"""


# --- rule spans -----------------------------------------------------------------------------------

RULES_SQL = (
    DOCS_SQL
    + ",\nhits AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {r} AS rule, '{k}' AS type, regexp_extract_all(text, '{form}') AS f, string_split_regex(text, '{form}') AS g FROM docs WHERE regexp_matches(text, '{form}')" for r, (k, form) in enumerate(emit.RULES)
    )
    + """),
cuts AS (SELECT doc_id, rule, type, unnest(list_zip(f, g[1:len(f)], range(0, len(f)))) AS z FROM hits),
sized AS (SELECT doc_id, rule, type, z[1] AS value, length(z[2]) AS gap, z[3] AS pos FROM cuts),
ends AS (SELECT doc_id, type, value, CAST(sum(gap + length(value)) OVER (PARTITION BY doc_id, rule ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INTEGER) AS "end" FROM sized),
spans AS (SELECT doc_id, CAST("end" - length(value) AS INTEGER) AS start, "end", type, value FROM ends)"""
)


def rule_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emit.rule_spans(docs(spark, sf_dir), ["doc_id"])


# --- tokens ---------------------------------------------------------------------------------------

def tokens_sql(source: str = "docs", key: str = "doc_id") -> str:
    return f"""
parts AS (SELECT {key}, regexp_extract_all(text, '{TOKEN}') AS f, string_split_regex(text, '{TOKEN}') AS g FROM {source} WHERE text IS NOT NULL),
zipped AS (SELECT {key}, unnest(list_zip(f, g[1:len(f)], range(0, len(f)))) AS z FROM parts),
tok AS MATERIALIZED (
  SELECT {key}, CAST(z[3] AS INTEGER) AS tok_idx, z[1] AS tok,
    CAST(sum(length(z[2]) + length(z[1])) OVER w - length(z[1]) AS INTEGER) AS start, CAST(sum(length(z[2]) + length(z[1])) OVER w AS INTEGER) AS "end"
  FROM zipped WINDOW w AS (PARTITION BY {key} ORDER BY z[3] ROWS UNBOUNDED PRECEDING))"""


TOKENS_SQL = DOCS_SQL + "," + tokens_sql()


def tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(docs(spark, sf_dir))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_rows(tokenized(spark, sf_dir), "doc_id")


# --- tokens with made-up labels: every kind of label, good and bad, in all orders -----------------------

_KINDS = (*tax.LABELS, "MAL", "X-NOME_PESSOA", "B-")
_KIND_SQL = "[" + ", ".join(text_literal(x) for x in _KINDS) + "]"
MARKED_SQL = TOKENS_SQL + f""",
marked AS (
  SELECT doc_id, tok_idx, CASE WHEN tok_idx % 97 = 5 THEN 0 ELSE start END AS start, CASE WHEN tok_idx % 97 = 5 THEN 0 ELSE "end" END AS "end",
    CASE WHEN (("end" - start) * 7 + (tok_idx // 3) * 13 + doc_id) % 40 BETWEEN 0 AND {len(_KINDS) - 1} THEN ({_KIND_SQL})[(("end" - start) * 7 + (tok_idx // 3) * 13 + doc_id) % 40 + 1] ELSE 'O' END AS label,
    ((tok_idx * 37 + start) % 101) / 100.0::DOUBLE AS prob FROM tok)"""  # noqa: E501


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_rows(spark, sf_dir)
    k = F.expr("((`end` - start) * 7 + (tok_idx div 3) * 13 + doc_id) % 40")
    special = F.col("tok_idx") % 97 == 5
    label = F.when((k >= 0) & (k < len(_KINDS)), F.get(F.array(*map(F.lit, _KINDS)), k.cast("int"))).otherwise("O")
    return rows.select(
        "doc_id", "tok_idx", F.when(special, 0).otherwise(F.col("start")).alias("start"), F.when(special, 0).otherwise(F.col("end")).alias("end"),
        label.alias("label"), (((F.col("tok_idx") * 37 + F.col("start")) % 101) / F.lit(100.0)).alias("prob"),
    )


# --- logits: each vector folded to 27 numbers, in sequences of 128 by vec_id ----------------------------

LOGITS_SQL = """seq AS (
  SELECT vec_id // 128 AS seq_id, CAST(row_number() OVER (PARTITION BY vec_id // 128 ORDER BY vec_id) - 1 AS INTEGER) AS tok_idx,
    list_transform(range(1, 28), lambda k: CAST(CAST(embedding[k] AS DOUBLE) + embedding[k + 27] + coalesce(embedding[k + 54], 0) AS FLOAT)) AS logits FROM embeddings),
lg AS (SELECT seq_id, tok_idx, tok_idx * 5 AS start, tok_idx * 5 + 4 AS "end", logits FROM seq)"""


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    n, e = len(tax.LABELS), F.col("embedding").cast("array<double>")
    folded = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: (F.get(e, k) + F.get(e, k + n) + F.coalesce(F.get(e, k + 2 * n), F.lit(0.0))).cast("float"))
    rows = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 128").alias("seq_id"), "vec_id", folded.alias("logits"))
    rows = rows.withColumn("tok_idx", F.row_number().over(Window.partitionBy("seq_id").orderBy("vec_id")) - 1)
    return rows.select("seq_id", "tok_idx", (F.col("tok_idx") * 5).alias("start"), (F.col("tok_idx") * 5 + 4).alias("end"), "logits")
