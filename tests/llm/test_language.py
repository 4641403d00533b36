import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import language as L

TEXTS = {
    "en": ["the parcel has not arrived yet and I would like my money back", "could you please tell me where the order is now", "thank you for your help with this problem"],
    "de": ["das Paket ist noch nicht angekommen und ich möchte mein Geld zurück", "können Sie mir bitte sagen wo die Bestellung jetzt ist", "vielen Dank für Ihre Hilfe bei diesem Problem"],
    "fr": ["le colis n'est pas encore arrivé et je voudrais être remboursé", "pouvez vous me dire où se trouve la commande maintenant", "merci beaucoup pour votre aide avec ce problème"],
    "es": ["el paquete no ha llegado todavía y quiero que me devuelvan el dinero", "me puede decir dónde está el pedido ahora", "muchas gracias por su ayuda con este problema"],
    "it": ["il pacco non è ancora arrivato e vorrei un rimborso", "mi può dire dove si trova adesso il mio ordine", "grazie mille per il vostro aiuto con questo problema"],
    "pt": ["o pacote ainda não chegou e eu quero o meu dinheiro de volta", "você pode me dizer onde está o pedido agora", "muito obrigado pela sua ajuda com este problema"],
    "hi": ["मेरा पार्सल अभी तक नहीं आया है और मुझे पैसे वापस चाहिए", "mera parcel abhi tak nahi aaya hai aur mujhe paise wapas chahiye", "kripya batao ki mera order abhi kahan hai"],
    "ta": ["என் பார்சல் இன்னும் வந்து சேரவில்லை பணம் திரும்ப வேண்டும்", "ஆர்டர் இப்போது எங்கே இருக்கிறது என்று சொல்லுங்கள்", "உங்கள் உதவிக்கு மிக்க நன்றி"],
}


@pytest.fixture(scope="module")
def model():
    return L.fit_on([(k, t) for k, ts in TEXTS.items() for t in ts for _ in range(5)], L.load_pieces(L.vocabulary_path()))


def by_hand(model, word):
    """All segmentations, one after the other."""
    if not word:
        return np.ones(len(L.LANGS))
    total = np.zeros(len(L.LANGS))
    for j in range(1, len(word) + 1):
        if word[:j] in model.pieces or j == 1:
            total += model.p.get(word[:j], model.floor) * by_hand(model, word[j:])
    return total


def test_forward_sums_all_segmentations(model):
    for w in (b" order", b" nahi", " où".encode(), b"x"):
        assert np.allclose(model.forward(w), by_hand(model, w), rtol=1e-9)


def test_em_gives_distributions(model):
    assert np.allclose(sum(model.p.values()), 1, atol=0.01)


def test_viterbi_equals_brute_force():
    from itertools import product

    r = np.random.default_rng(0)
    sizes = np.array([5, 1, 6, 0, 4])
    n = int(sizes.sum())
    scores, breaks = r.normal(size=(n, 3)) * 3, r.random(n) < 0.3
    path = L.best_sequences(scores, breaks, sizes, 2.0, 0.7)
    at = 0
    for s in sizes:
        def value(p):
            return sum(scores[at + i, p[i]] - (0 if i == 0 or p[i] == p[i - 1] else (0.7 if breaks[at + i] else 2.0)) for i in range(s))

        if s:
            assert abs(value(path[at : at + s]) - max(map(value, product(range(3), repeat=int(s))))) < 1e-9
        at += s


def test_segments_and_edge_cases(spark, model):
    rows = [
        ("a", "the order has not arrived and I would like my money. mi può dire dove si trova il mio ordine"),
        ("b", ""), ("c", None), ("d", "ok"), ("e", "12345 !!! 😀"), ("f", "vielen Dank für Ihre Hilfe. " * 3000), ("a", "the order has not arrived and I would like my money. mi può dire dove si trova il mio ordine"),
    ]
    df = spark.createDataFrame(rows, "message_id string, text string").withColumn("segments", F.lit(1))
    got = {r["message_id"]: r["segments"] for r in L.detect(df, model).collect()}
    assert [s["lang"] for s in got["a"]] == ["en", "it"] and [s["seg_no"] for s in got["a"]] == [0, 1] and all(0 < s["confidence"] <= 1 for s in got["a"])
    assert got["b"] == got["c"] == got["e"] == [] and len(got["d"]) == 1 and [s["lang"] for s in got["f"]] == ["de"]
    assert L.detect(df.where("false"), model).count() == 0


def test_short_stretches_join_their_neighbours(model):
    runs = L.segment_batch(model, ["hola order where is it now please tell me"], min_words=4)[0]
    assert [L.LANGS[r[0]] for r in runs] == ["en"]


def test_labels(spark):
    rows = [("c", [("m", ["de - German", "en - English"]), ("n", None), ("o", ["no lang found - No Language Found"]), (None, ["de - German"])]), ("d", None)]
    df = spark.createDataFrame(rows, "conversation_id string, detected_languages array<struct<message_id:string,languages:array<string>>>")
    assert {r["message_id"]: r["codes"] for r in L.label_codes(df).collect()} == {"m": ["de", "en"], "n": [], "o": []}


def test_held_out_accuracy_on_the_tables(spark):
    """Agreement with the (noisy) single labels of messages that the fit has not seen."""
    d = "/root/testdata/sf0.01"
    labels = L.label_codes(spark.read.parquet(f"{d}/language_annotations.parquet")).where(F.size("codes") == 1)
    m = spark.read.parquet(f"{d}/messages.parquet").where("source = 'whatsapp' and length(text) > 30").dropDuplicates(["message_id"])
    rows = m.join(labels, "message_id").select("message_id", "text", F.col("codes")[0].alias("lang"))
    fold = F.pmod(F.xxhash64("message_id"), F.lit(3)) == 0
    model = L.fit_model(rows.where(~fold), rows_per_language=400)
    got = L.detect(rows.where(fold & F.col("lang").isin(*L.LANGS)), model).select("lang", F.col("segments")[0]["lang"].alias("p")).collect()
    assert sum(r[0] == r[1] for r in got) / len(got) > 0.85
