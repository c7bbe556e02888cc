import pytest
from pyspark.sql import functions as F

from velatura.functions import taxonomy as tax
from velatura.functions import text as tx
from velatura.functions import values as vals
from velatura.functions.rules import format_error

CLEAN = [
    ("DOC_PESSOAL", "CPF: 123.456.789-00", "123.456.789-00"), ("ID_PROCESSUAL", "SEI nº 123456/2023", "123456/2023"), ("ID_PROCESSUAL", "processo novo 12", "ovo 12"),
    ("ORG_JURIDICA", "Empresa Brasileira de Correios", "Brasileira de Correios"), ("DOC_EMPRESA", "IMPRENSA NACIONAL", "PRENSA NACIONAL"), ("NOME_PESSOA", "CPF: x", "CPF: x"),
    ("ID_PROCESSUAL", "MATRÍCULA Nº 12 - ", "12"), ("ID_PROCESSUAL", "processo sei processo SEI nº. 99", "99"), ("CONTATO", "e-mail: tel: a@b.c", "a@b.c"), ("DOC_PESSOAL", "CPF", "CPF"), ("X", "cpf 1", "cpf 1"),
]


def test_sanitize(spark):
    rows = spark.createDataFrame([(k, v, f"antes {v} depois", w) for k, v, w in CLEAN], "k string, v string, t string, w string")
    for r in rows.select("v", "w", vals.sanitize(F.col("k"), F.col("v"), F.col("t")).alias("got")).collect():
        assert r["got"] == r["w"], r
    again = rows.select("w", vals.sanitize(F.col("k"), F.col("w"), F.col("t")).alias("got"))
    assert all(r["got"] == r["w"] for r in again.collect())
    gone = spark.createDataFrame([("DOC_PESSOAL", "CPF: 1", "CPF: 1")], "k string, v string, t string").select(vals.sanitize(F.col("k"), F.col("v"), F.lit("other")).alias("g"))
    assert gone.first()["g"] == "CPF: 1"


GOOD = {
    "DOC_PESSOAL": ["129.180.122-6"], "ID_PROCESSUAL": ["123456/2023", "123456", "85-SES/DF"], "ID_VEICULO": ["ABC-1234", "ABC1D23", "123456789"], "DOC_EMPRESA": ["25.598.301/0001-68", "110.042.490.114"],
    "DADO_FINANCEIRO": ["12345-6", "email@x.com"], "ORG_JURIDICA": ["CGU", "DF LEGAL", "5ª DP", "Detran"], "CONTATO": ["a@b.com", "(61) 99999-8888"], "DATA_NASC": ["em 1/2/90."], "DOC_PROFISSIONAL": ["CRM 123"],
    "QUASI_IDENTIFICADOR": ["motorista da linha 805.6, no horário das 07h15"], "ENDERECO": ["Rua 7", "QD 12"], "DADO_SAUDE": ["laudo de CID"], "NOME_PESSOA": ["João Silva"],
}
BAD = {
    "DOC_PESSOAL": [("CPF", "digits"), ("RG novo 123456", "adjective"), ("cpf: 12345", "prefix")], "ID_PROCESSUAL": [("SEI nº 123456/2023", "verbose"), ("1", "digits"), ("12", "digits")],
    "ID_VEICULO": [("placa ABC-1234", "no_plate")], "DOC_EMPRESA": [("IE 123456", "space"), ("12345", "digits"), ("a123456", "letters")], "DADO_FINANCEIRO": [("0850", "digits"), ("3456", "digits"), ("Conta 1", "verbose")],
    "ORG_JURIDICA": [("URGENTE", "generic"), ("GPS", "acronym"), ("SILVA", "surname"), ("SECRETÁRIO DE ESTADO", "title"), ("25.598.301/0001-68", "number"), ("1", "implausible")],
    "CONTATO": [("a@b", "mail_domain"), ("a@b.com.", "mail_tail"), ("1234567", "phone_digits"), ("a b@c.d", "mail_space"), ("a@@b.c", "mail_at")], "QUASI_IDENTIFICADOR": [("linha 805.6", "words"), ("a b c", "short")],
    "ENDERECO": [("Rua sete", "no_number"), ("7 de abril", "no_marker")], "DADO_SAUDE": [("Laudo", "generic")], "NOME_PESSOA": [("João 2", "digits"), ("o Sr", "title")], "DATA_NASC": [("2020", "no_date")],
    "DOC_PROFISSIONAL": [("12", "digits")],
}


@pytest.mark.parametrize("kind", tax.TYPES)
def test_format_rules(spark, kind):
    rows = [(v, None) for v in GOOD[kind]] + BAD[kind] + [("", "empty"), (" x", "untrimmed"), ("a\nb 123456", "newline"), ("x" * 221, "too_long"), (None, "empty")]
    got = spark.createDataFrame(rows, "v string, want string").select("v", "want", format_error(kind, F.col("v")).alias("got"), format_error(F.lit(kind), F.col("v")).alias("any"))
    for r in got.collect():
        assert r["got"] == r["want"] == r["any"], r
    assert spark.range(1).select(format_error(F.lit("NOPE"), F.lit("x")).alias("e")).first()["e"] == "unknown_type"


def test_occurrences(spark):
    cases = [("aaaa", "aa", [0, 2], [0, 1, 2]), ("a.a.a", ".", [1, 3], [1, 3]), ("x", "xx", [], []), ("😀a😀a", "a", [1, 3], [1, 3]), ("q\\Eq\\E", "\\E", [1, 4], [1, 4]), ("abc", "", [], []), ("(a)(a)", "(a)", [0, 3], [0, 3])]
    rows = spark.createDataFrame([(t, v, a, b) for t, v, a, b in cases], "t string, v string, a array<int>, b array<int>")
    for r in rows.select("t", "a", "b", tx.occurrences(F.col("t"), F.col("v")).alias("x"), tx.occurrences_overlapping(F.col("t"), F.col("v")).alias("y")).collect():
        assert (r["x"], r["y"]) == (r["a"], r["b"]), r


def test_company_keywords(spark):
    cases = [("CNPJ 110.042", True), ("inscrição estadual nº 110.042", True), ("I.E. 110.042", True), (" i m: 110.042", True), ("série 110.042", False), ("cnpj" + " " * 60 + "110.042", False), ("x", False)]
    rows = spark.createDataFrame(cases, "t string, w boolean")
    for r in rows.select("t", "w", vals.has_company_keyword(F.col("t"), F.lit("110.042")).alias("g")).collect():
        assert r["g"] == r["w"], r


def test_canonical(spark):
    row = spark.createDataFrame([("ORG_JURIDICA", "25.598.301/0001-68", "CNPJ 25.598.301/0001-68"), ("ID_PROCESSUAL", "CPF", "CPF")], "k string, v string, t string")

    def run(**how):
        k, v = vals.canonical(F.col("k"), F.col("v"), F.col("t"), **how)
        return [tuple(r) for r in row.select(k.alias("k"), v.alias("v")).collect()]

    assert run(normalize=True, migrate=True)[0] == ("DOC_EMPRESA", "25.598.301/0001-68")
    assert run(normalize=False, migrate=True)[0][0] == "ORG_JURIDICA"  # migration acts only inside normalisation


def test_small_formats(spark):
    r = spark.range(1).select(
        tx.format_int(F.lit(1234567)).alias("n"), tx.format_score(F.lit(0.5)).alias("s"), tx.escape_html(F.lit("<a&b>\n")).alias("h"), tx.table_cell(F.lit("a|b\n")).alias("c"),
        tx.excerpt(F.lit("  a \n b  "), 10).alias("e"), tx.excerpt(F.lit("abcdefghij k"), 5).alias("f"),
    ).first()
    assert tuple(r) == ("1.234.567", "0.5000 (50.00%)", "&lt;a&amp;b&gt; ", r"a\|b ", "a b", "abcd…")


def test_labels(spark):
    assert len(tax.LABELS) == 27 and tax.LABELS[:3] == ("O", "B-NOME_PESSOA", "I-NOME_PESSOA")
    assert tax.label_maps({"O": "0"}, {"0": "O"}) == ({"O": 0}, {0: "O"})
    assert tax.label_maps()[0]["I-QUASI_IDENTIFICADOR"] == 26
    rows = spark.createDataFrame([("O",), ("B-X",), ("I-",), ("Z-X",), ("BX",), ("B-A-B",)], "l string")
    got = rows.select(tax.is_bio(F.col("l")), tax.bio_prefix(F.col("l")), tax.bio_type(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(True, "O", None), (True, "B", "X"), (False, "O", None), (False, "O", None), (False, "O", None), (True, "B", "A-B")]
