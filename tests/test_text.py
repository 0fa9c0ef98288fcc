import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import text
from ledgerlens.functions.names import normalise_columns, normalise_name
from ledgerlens.functions.stemming import stem

# Examples of the 1980 paper and of the later additions.
STEMS = """
caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop
tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc digitizer digit radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous
formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
probate probat rate rate cease ceas controll control roll roll enjoy enjoy spied spi died die
apologi apolog dying die by by yes ye oscillate oscil
""".split()


def one(spark, value, function):
    frame = spark.createDataFrame([(value,)], "t string")
    return frame.select(function(F.col("t")).alias("x")).first()["x"]


def test_stems_follow_the_paper(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    found = spark.createDataFrame(pairs, "word string, wanted string").withColumn(
        "stem", stem(F.col("word")))
    assert [(r.word, r.stem) for r in found.where("stem <> wanted").collect()] == []


@pytest.mark.parametrize("raw, clean", [
    ("Água! “café” – R$ 10,5", 'agua "cafe" - r'),
    ("zł €5 £7 ¥9", ""),
    ("São  João\n\tGoiás", "sao joao goias"),
    ("straße Œuvre nº 12", "strasse oeuvre no"),
    ("日本 ok 🙂 fim", "ok fim"),
    ("http://www.x.com a@b.c", "http www x com a b c"),
    ("a b​c", "a bc"),
    (None, ""),
    ("", ""),
])
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, text.clean_text) == clean


def test_punctuation_is_exactly_the_ascii_symbols(spark):
    import string
    assert one(spark, f"a{string.punctuation}b", text.punctuation_to_space) == "a" + " " * 32 + "b"
    assert one(spark, "a–b", text.punctuation_to_space) == "a–b"


def test_normalise_keeps_punctuation(spark):
    assert one(spark, "A, b. 3$!", text.normalise_text) == "a, b. !"


def test_stopwords_match_folded_text_only_on_request(spark):
    plain, folded = text.stopwords(spark), text.stopwords(spark, fold=True)
    assert "não" in plain and "nao" not in plain and "nao" in folded

    def kept(words):
        return one(spark, "não total de x compra GO mês",
                   lambda c: text.drop_stopwords(text.clean_text(c), words))

    assert kept(plain) == ["nao", "compra"]
    assert kept(folded) == ["compra"]


def test_bag_terms_split_inside_words(spark):
    terms = one(spark, "l’eau connections “running”", lambda c: text.bag_terms(c, []))
    # The quote is part of the word while it is stemmed, and separates terms afterwards.
    assert terms == ["eau", "connect", "running"]


def test_oracle_stopwords_equal_the_list_in_use(spark):
    from ledgerlens.plans.oracles import STOPWORDS
    usable = [w for w in text.stopwords(spark) if w.isascii() and len(w) > 1]
    assert sorted(set(usable)) == sorted(set(STOPWORDS))


@pytest.mark.parametrize("header, name", [
    ("Órgão (Código/Nome)", "orgao"),
    ("Período (Dia/Mes/Ano)", "periodo"),
    ("Natureza Despesa (Cod)", "natureza_despesa_cod"),
    ("Beneficiário (CPF/CNPJ)", "beneficiario_cpf/cnpj"),
    ("Valor Estorno Anulação O. Pagamento", "valor_estorno_anulacao_o_pagamento"),
    ("Função (Cod/Nome)", "funcao"),
    ("Saldo (EOF)", "saldo_"),
])
def test_names(header, name):
    assert normalise_name(header) == name


def test_name_collision_is_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        normalise_columns(spark.createDataFrame([(1, 2)], "`Ação` int, `acao` int"))


def test_words_without_a_listed_ending_skip_the_rules(spark):
    from ledgerlens.functions.stemming import CHANGEABLE, listed_suffixes
    kept = ["amplo", "banco", "und", "Verb", "club", "wind"]
    assert not any(word.endswith(tuple(CHANGEABLE)) for word in kept)
    rows = spark.createDataFrame([(word,) for word in kept], "word string")
    found = rows.select("word", stem(F.col("word")).alias("a"),
                        listed_suffixes(F.col("word")).alias("b")).collect()
    assert all(r.a == r.word.lower() and r.b == r.word for r in found)


def test_index_terms_of_letters_alone_are_not_searched_for(spark):
    def terms(column):
        return text.index_terms(column)
    plan = spark.range(1).select(terms(F.split(F.lit("a bc"), " ")).alias("t"))
    assert "CASE WHEN" in plan._jdf.queryExecution().analyzed().toString()
    for words, wanted in ((["a", "bc", "def"], ["bc", "def"]), (["l'eau", "x1yz"], ["eau", "yz"]),
                          ([], []), (["a"], [])):
        rows = spark.createDataFrame([(words,)], "t array<string>")
        assert rows.select(terms("t").alias("x")).first()["x"] == wanted
