"""What the network learns from, at the edges of its bound."""

from __future__ import annotations

from martkit.llm import language_id


def test_sample_holds_every_language(spark):
    """Null and letterless rows of one language, and more languages than the bound has rows for."""
    many = [(1000 * k + i, f"text of language {k}", f"l{k:03}") for k in range(150) for i in range(6)]
    rare = [(10**6 + i, None if i % 2 else "12", "rare") for i in range(40)] + [(2 * 10**6 + i, "rare words", "rare") for i in range(6)]
    docs = spark.createDataFrame(many + rare, "doc_id bigint, text string, lang string").repartition(5)
    net = language_id.learn(docs, rows_per_language=3, windows_per_row=1, steps=1)
    assert net.languages == sorted({lang for _, _, lang in many + rare})


def test_sample_is_bounded_in_rows_and_holds_rows_without_id(spark):
    """Thousands of rows of one id; languages whose rows have no id at all."""
    same = [(8, f"words of many rows number {chr(97 + i % 26)}{i}", "en") for i in range(2000)]
    none = [(None, f"andere worte {chr(97 + i % 26)}{i}", "de") for i in range(50)]
    docs = spark.createDataFrame(same + none, "doc_id bigint, text string, lang string").repartition(5)
    seen = []
    real = language_id.train
    try:
        language_id.train = lambda windows, labels, languages, **o: seen.append(labels) or real(windows, labels, languages, **o)
        net = language_id.learn(docs, rows_per_language=20, windows_per_row=1, steps=1)
    finally:
        language_id.train = real
    assert net.languages == ["de", "en"] and [int((seen[0] == k).sum()) for k in (0, 1)] == [20, 20]


def test_network_by_plain_loops(spark):
    """Probabilities, labels and score of a text, one byte after another in plain Python."""
    import math

    net = language_id.Network(["a", "b", "c"], 5, 9)
    text = "Ein Satz, two words; éà " * 7
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def states(layer, data):
        h, out = [0.0] * 5, []
        for byte in data:
            gate = [sigmoid(float(layer.gates_in[i, byte]) + sum(float(layer.gates_on[i, j]) * h[j] for j in range(5))) for i in range(10)]
            new = [
                math.tanh(float(layer.new_in[i, byte]) + sum(float(layer.new_on[i, j]) * gate[5 + j] * h[j] for j in range(5)))
                for i in range(5)
            ]
            h = [h[i] + gate[i] * (new[i] - h[i]) for i in range(5)]
            out.append(h)
        return out

    total, best = [0.0] * 3, [0] * 3
    for window in language_id.windows_of(text.encode()):
        data = [int(x) for x in window]
        ahead, back = states(net.ahead, data), states(net.back, data[::-1])[::-1]
        for byte, f, b in zip(data, ahead, back):
            if byte == language_id.PAD:
                continue
            z = [
                float(net.bias[k, 0]) + sum(float(net.out_ahead[k, i]) * f[i] + float(net.out_back[k, i]) * b[i] for i in range(5))
                for k in range(3)
            ]
            e = [math.exp(x) for x in z]
            p = [x / sum(e) for x in e]
            total = [x + y for x, y in zip(total, p)]
            best[p.index(max(p))] += 1
    size = len(text.encode())
    got = language_id.identify(spark.createDataFrame([(text,)], "text string"), net).first()
    assert got.lang_pred == net.languages[total.index(max(total))]
    assert abs(got.score - max(total) / size) < 1e-4 and abs(got.agreement - best[total.index(max(total))] / size) < 1e-2


def test_mixed_and_mislabelled_texts_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 400")
    text = {r.lang: r.text for r in docs.groupBy("lang").agg({"text": "max"}).withColumnRenamed("max(text)", "text").collect()}
    a, b = sorted(text)[:2]
    cut = min(len(text[a]), len(text[b]))
    planted = [
        (-1, text[a][:cut] + " " + text[b][:cut], a),
        (-2, text[a], b),
        (-3, text[a], None),
        (-4, text[b], "xx"),
        (-5, " 12 ", a),
    ]
    table = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(planted, "doc_id bigint, text string, lang string"))
    kept = {r.doc_id: r.lang for r in language_id.keep_identified(table).collect()}
    assert {i: kept.get(i) for i in range(-5, 0)} == {-1: None, -2: None, -3: a, -4: "xx", -5: None}
    assert len(kept) >= 0.995 * docs.count()
