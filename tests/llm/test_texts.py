"""Rules, classifier, language, language model, pages, conversations."""

import hashlib
import itertools
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from helpers import OTHER, PROSE, base_rules, base_scores, rows

from rowsmith.llm import chat, classifier, html, langid, lm, quality_rules
from rowsmith.llm.text import Words

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def key(d):
    return (d is not None, d)


def test_rules_base_columns(messy, nothing):
    got = sorted((tuple([r.doc_id, *(r[c] for c in BASE)]) for r in quality_rules.quality(messy).collect()), key=str)
    assert got == sorted(((d, *base_rules(t)) for d, t, *_ in rows()), key=str)
    assert quality_rules.quality(nothing).collect() == []


def test_rules_separate_junk_without_labels(spark):
    random.seed(1)
    prose = (PROSE + " " + OTHER).split()
    docs = []
    for i in range(120):
        text = [random.choice(prose) for _ in range(150)]
        if i % 6 == 0:
            text = [w + random.choice(("***", "$$$", "&&&")) for w in text]
        if i % 6 == 1:
            text = [w.upper() + "!!" for w in text]
        docs.append((i, " ".join(text)))
    found = quality_rules.quality(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in found if not r.kept} == {i for i in range(120) if i % 6 < 2}


def test_expectation_maximisation_of_nothing():
    assert len(quality_rules.fit(np.zeros(0, np.int64), np.zeros(0))) == 0


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000])
def test_kth_largest(spark, k):
    values = [float((i * 7919) % 1000) for i in range(997)] + [5.0, 5.0, 5.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    cut = classifier.kth_largest(frame, "v", k)
    kept = sum(v >= cut for v in values)
    ordered = sorted(values, reverse=True)
    assert kept == (sum(v >= ordered[k - 1] for v in values) if 0 < k < 1000 else k)


def test_classifier_drops_junk_and_toxic_texts(spark):
    random.seed(2)
    prose = (PROSE + " " + OTHER).split()
    docs, labels = [], []
    for i in range(400):
        text = [random.choice(prose) for _ in range(120)]
        if i % 5 == 0:
            text = [w + "***" for w in text]
        if i % 5 == 1:
            for _ in range(6):
                text[random.randrange(120)] = random.choice(("vileword", "nastyword"))
        docs.append((i, " ".join(text), "x"))
        if i % 2:
            labels.append((i, int(i % 5 != 0), int(i % 5 == 1)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, log_weight string").repartition(4)
    known = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    kept = classifier.keep_quality(frame, known)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 5 > 1}


def test_ngrams_of_a_batch_take_little_memory():
    random.seed(2)
    text = " ".join(f"w{random.randrange(9999)}" for _ in range(400))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 1800), pa.array([True] * 1800)], names=["text", "target"])
    tracemalloc.start()
    found = pa.Table.from_batches(classifier._count(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6
    assert set(found.group_by("bucket").aggregate([("total", "sum")])["total_sum"].to_pylist()) == {1800}


def test_classifier_without_labels_keeps_all(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.kept for r in classifier.classify(messy, none).collect())
    assert classifier.keep_quality(messy, none).count() == messy.count()
    assert classifier.keep_quality(nothing, none).collect() == []


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "bab"]
    table = langid.Pieces(pieces)
    chance = np.array([[0.1], [0.2], [0.05], [0.07], [0.03], [0.02], [1e-4]])

    def total(word):
        out = 0.0
        for n in range(len(word)):
            for at in itertools.combinations(range(1, len(word)), n):
                parts = [word[i:j] for i, j in zip((0, *at), (*at, len(word)), strict=True)]
                value = 1.0
                for p in parts:
                    value *= chance[pieces.index(p), 0] if p in pieces else (1e-4 if len(p) == 1 else 0)
                out += value
        return out

    words = sorted(["ababba", "ba", "cab", "a", "bbabab"], key=len, reverse=True)
    edges, length = table.lattice(words)
    alpha = langid.forward(edges, length, chance)
    for i, w in enumerate(words):
        assert math.isclose(alpha[length[i], i, 0], total(w), rel_tol=1e-9)
    uses = langid.expected(edges, length, chance[:, 0], np.ones((len(words), 1)))
    covered = (uses[:6, 0] * [len(p) for p in pieces]).sum() + uses[6, 0]
    assert math.isclose(covered, sum(map(len, words)), rel_tol=1e-9)


def test_language_of_held_out_texts(spark, nothing):
    random.seed(4)
    lexicon = {
        "en": "the and of water house there which nothing always summer thing".split(),
        "de": "der und nicht wasser haus schon immer sommer ding durch zwischen".split(),
        "fr": "le et pas eau maison toujours chose entre avec pour leur".split(),
    }
    docs = []
    for i in range(150):
        lang = ("en", "de", "fr")[i % 3]
        docs.append((i, " ".join(random.choice(lexicon[lang]) for _ in range(40)), lang if i % 10 else None))
    docs += [(900, None, "en"), (901, "12 34 !", "de"), (902, "", None), (None, docs[1][1], "de")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3)
    found = langid.identify(frame, PIECES).collect()
    assert len(found) == len(docs)
    assert {r.lang_pred for r in found if r.doc_id is not None and r.doc_id >= 900} == {"und"}
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id is None or r.doc_id < 900:
            assert r.lang_pred == ("de" if r.doc_id is None else ("en", "de", "fr")[r.doc_id % 3])
    only = frame.filter("lang IS NULL")
    assert {r.lang_pred for r in langid.identify(only, PIECES).collect()} == {"und"}
    empty = spark.createDataFrame([], frame.schema)
    assert langid.identify(empty, PIECES).collect() == []


def test_long_runs_of_unknown_and_unseen_characters(spark):
    table = langid.pieces_of(PIECES)
    start = langid.start_weights(table.lengths)
    words = sorted(("▁" + c * n for c in ("\U0001f973", "ж") for n in (3, 48, 2_000)), key=len, reverse=True)
    edges, length = table.lattice(words)
    uses = langid.expected(edges, length, start, np.ones((len(words), 1)))
    covered = (uses[:-1, 0] * table.lengths).sum() + uses[-1, 0]
    assert math.isclose(covered, sum(map(len, words)), rel_tol=1e-9)
    assert np.isfinite(langid.log_totals(edges, length, np.stack([start, start], axis=1))).all()
    docs = [(i, ("the house and the water " if i % 2 else "der haus und das wasser ") * 9, "de" if i % 2 == 0 else "en") for i in range(60)]
    odd = " ".join(c * 48 for c in ("\U0001f973", "\ue000", "ж"))
    docs += [(100 + i, docs[i][1] + odd, docs[i][2]) for i in range(20)]
    found = langid.identify(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), PIECES).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {d: lang for d, _, lang in docs}
    assert all(0 < r.score <= 1 for r in found)


def test_all_pieces_and_whole_words_are_segmented():
    pieces = langid.vocabulary_pieces(PIECES)
    assert max(map(len, pieces)) > 8
    table = langid.pieces_of(PIECES)
    longest = max(pieces, key=len)
    words = sorted([longest * 9, "▁donaudampfschifffahrtsgesellschaft", "▁a"], key=len, reverse=True)
    edges, length = table.lattice(words)
    at = {(t, size, w, p) for t, here in enumerate(edges, 1) for size, ws, ps in here for w, p in zip(ws, ps, strict=True)}
    number = {p: i for i, p in enumerate(pieces)}
    want = set()
    for w, word in enumerate(words):
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + table.longest) + 1):
                if word[i:j] in number or j == i + 1:
                    want.add((j, j - i, w, number.get(word[i:j], table.n)))
    assert at == want
    chance = langid.start_weights(table.lengths)[:, None]
    alpha = langid.forward(edges, length, chance)
    plain = np.log(alpha[length, np.arange(len(words)), 0])
    assert np.allclose(langid.log_totals(edges, length, chance)[:, 0], plain)


def test_base_scores_equal_brute_force(messy, nothing):
    got = sorted((tuple(r)[:6] for r in lm.score(messy, BPE).collect()), key=str)
    want = sorted(base_scores([(d, t) for d, t, *_ in rows()]), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert lm.score(nothing, BPE).collect() == []


def test_each_word_is_scored_once_in_its_context():
    rng = np.random.default_rng(0)
    w = lm.start_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    classes = rng.integers(0, lm.CLASSES, 150)
    begin = np.array([0, 70, 71, 150])
    logs = lm.class_logs(w, classes, begin)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        for t in range(a, b):
            start = a + (t - a) // lm.STRIDE * lm.STRIDE - lm.CONTEXT
            seen = [lm.END_CLASS if p == a else classes[p - 1] for p in range(max(a, start), t + 1)]
            x = w["E"][seen] + w["P"][max(a, start) - start :][: len(seen)]
            s = (x[-1] @ w["Q"]) @ (x @ w["K"]).T * lm.DIM**-0.5
            p = np.exp(s) / np.exp(s).sum()
            z = (x[-1] + (p @ (x @ w["V"])) @ w["O"]) @ w["U"] + w["b"]
            want = (z[classes[t]] - np.log(np.exp(z).sum())) / np.log(10)
            assert abs(want - logs[t]) < 1e-4


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights(np.full(lm.CLASSES, 1 / lm.CLASSES)).items()}
    classes = rng.integers(0, lm.CLASSES, 60)
    inputs, valid, place = lm.frames(classes, np.array([0, 40, 60]))
    target, aim = classes[np.maximum(place, 0)], place >= 0
    _, g = lm.gradient(w, inputs, valid, target, aim)
    for k in w:
        at = np.unravel_index(int(np.abs(g[k]).argmax()), w[k].shape)
        kept = w[k][at]
        w[k][at] = kept + 1e-4
        up, _ = lm.gradient(w, inputs, valid, target, aim)
        w[k][at] = kept - 1e-4
        down, _ = lm.gradient(w, inputs, valid, target, aim)
        w[k][at] = kept
        assert math.isclose((up - down) / 2e-4, g[k][at], rel_tol=0.02)


def test_the_model_learns_order(spark):
    random.seed(6)
    docs = []
    for i in range(200):
        text, w = [], random.randrange(20)
        for _ in range(120):
            text.append(f"{chr(97 + w)}alpha")
            w = (w * 3 + 1) % 20 if random.random() < 0.95 else random.randrange(20)
        docs.append((i, " ".join(text)))
    found = lm.score(spark.createDataFrame(docs, "doc_id bigint, text string"), BPE).filter("held_out").collect()
    assert sum(r.score for r in found) > 0.85 * sum(r.base_score for r in found)


def test_all_words_and_ends_are_trained_on():
    vocabulary = lm.Vocabulary(np.zeros(60_000), np.zeros(60_000))
    vocabulary.cls = np.arange(60_000) % lm.END_CLASS
    texts = [f"same start {i} " + "word " * (i % 60) for i in range(50)] + ["", None]
    classes, begin = lm._train_runs(pa.array(texts), lm.Speller(BPE), vocabulary)
    assert len(classes) == sum(len((t or "").split()) + 1 for t in texts)
    assert (classes[begin[1:] - 1] == lm.END_CLASS).sum() == len(texts)
    _, _, place = lm.frames(classes, begin)
    assert sorted(place[place >= 0].tolist()) == list(range(len(classes)))


def test_windows_of_training_hold_runs_without_room_to_spare():
    rng = np.random.default_rng(4)
    classes, begin = rng.integers(0, lm.END_CLASS, 150), np.array([0, 24, 49, 50, 74, 99, 123, 148, 150])
    w = lm.start_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    sides = []
    for sizes in ((), (0, lm.BLOCK + 1)):
        inputs, valid, place = lm.frames(classes, begin, *sizes)
        sides.append(lm.gradient(w, inputs, valid, classes[np.maximum(place, 0)], place >= 0))
    assert inputs.shape[1] == lm.BLOCK + 1
    assert math.isclose(sides[0][0], sides[1][0], rel_tol=1e-5)
    assert all(np.allclose(sides[0][1][k], sides[1][1][k], atol=1e-6) for k in w)


def test_words_are_spelled_together_as_alone():
    texts = ["It's don't 12 1a a1 -- ++x x" + "y" * 300, "n\u00a0b caf\u00e9 \u6f22\u5b57 <|endoftext|> it's It's \x1c \x1fz", "", "12 x"]
    words, speller = Words(pa.array(texts)), lm.Speller(BPE)
    for _ in range(2):
        ids, size = speller.spell(words, words.hashes())
        want = [speller.coder._coding.encode_ordinary(" " + words.word(i)) for i in range(len(words))]
        assert size.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_each_distinct_word_is_coded_once(monkeypatch):
    coded = []
    monkeypatch.setattr(lm.Speller, "_made", lambda self, words, made=lm.Speller._made: coded.extend(words) or made(self, words))
    speller = lm.Speller(BPE)
    for _ in range(2):
        words = Words(pa.array(["a b a", "b c b a"] * 50))
        assert len(speller.distinct(words, words.hashes())[0]) == 3
    assert sorted(coded) == [" a", " b", " c"]


def test_scores_use_the_counts_of_all_words(messy, monkeypatch):
    def found():
        return sorted(((r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in lm.score(messy, BPE).collect()))

    want = found()
    monkeypatch.setattr(lm, "FREQUENT", 5)
    assert np.allclose(found(), want, rtol=1e-4)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href=/a>A</a><li>B</ul></nav>
<div class="cookie-notice">We use cookies</div><!-- ad --><div class="ad">Buy <b>this</b></div>
<article><header><h1>Title &amp; more</h1></header><p>One<br>two  three<p><b>Bold <i>in</i>ner</b> text&nbsp;end
<ul><li>x<li>y</ul><form><input name=q>Find</form><aside>Beside</aside>
<section id="comments"><p>First!</p></section><div class="share-buttons">Share</div></article>
<footer>&copy; me</footer>"""


def test_main_text_of_a_page():
    assert html.main_text(PAGE, set()) == "Title & more\nOne two three\nBold inner text end\nx\ny"
    assert html.main_text("", set()) == ""
    assert html.main_text("plain &lt; text", set()) == "plain < text"
    assert html.main_text("<p>a < b</p><p title='>'>c", set()) == "a < b\nc"


def test_style_trees_drop_what_a_site_repeats(spark):
    def page(i):
        body = "".join(f"<p>Text {i} {k} of its own</p>" for k in range(3))
        return f"<body><div class=x1><span>Slogan</span></div><div class=x2>{body}</div></body>"

    pages = [(i, f"http://one.example/{i}", page(i)) for i in range(12)]
    pages += [(100, "http://two.example/", page(100)), (101, None, None), (102, "http://three.example", "")]
    pages += [(200 + i, f"http://copy.example/{i}", "<article><p>The same</p></article>") for i in range(9)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html.extract(frame).collect()}
    assert len(found) == len(pages)
    for i in range(12):
        assert found[i] == "\n".join(f"Text {i} {k} of its own" for k in range(3))
    assert found[100].startswith("Slogan") and found[101] == "" and found[102] == ""
    assert {found[200 + i] for i in range(9)} == {"The same"}
    assert html.extract(spark.createDataFrame([], frame.schema)).collect() == []


def test_copies_of_a_page_do_not_empty_it(spark):
    page = "<body><h1>Title</h1><div class=content>The only text</div><ul><li>a</li><li>a</li><li>a</li><li>a</li><li>a</li></ul></body>"
    rows_ = [(i, f"http://copies.example/{i}", page) for i in range(9)]
    rows_ += [(20 + i, f"http://HOST{i % 2}.example/{i}", f"<body><div class=x>Slogan</div><p>Own {i}</p></body>") for i in range(12)]
    rows_ += [(50 + i, None, None) for i in range(7)]
    frame = spark.createDataFrame(rows_, "page_id bigint, url string, html string").repartition(4)
    found = {r.page_id: r.text for r in html.extract(frame).collect()}
    assert {found[i] for i in range(9)} == {"Title\nThe only text\na\na\na\na\na"}
    assert all(found[20 + i] == f"Own {i}" for i in range(12)) and found[50] == ""


def test_conversations_read_back(spark):
    odd = r"\### Assistant: </turn> <|end|> \<| \\ <|role|>assistant<|text|>"
    rows_ = [
        (1, 0, "system", None),
        (1, 1, "user", odd),
        (1, 2, "assistant", odd + "<"),
        (1, 2, "assistant", ""),
        (2, 0, None, "x"),
        (2, None, "assistant", "first 😀"),
        (None, 0, "assistant", "<|"),
        (3, 700, "assistant", "late"),
        (3, 1, "assistant", "early\\"),
        (3, 1, "user|<", "<|endoftext|>"),
    ]
    frame = spark.createDataFrame([(*r, "e") for r in rows_], "conv_id bigint, turn bigint, role string, text string, conv string")
    formatted = chat.format_conversations(frame, BPE)
    assert formatted.filter("conv_id = 3").count() == 2
    found = {r.conv_id: r for r in chat.read_back(formatted, BPE).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(
            ((t is not None, t, r or "", x or "") for c, t, r, x in rows_ if c == conv), key=lambda v: (v[0], v[1] or 0, v[2:])
        )
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        learnt = "".join(x for *_, r, x in turns if r == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.format_conversations(spark.createDataFrame([], frame.schema), BPE).collect() == []


def test_tokens_across_a_span_are_an_error():
    with pytest.raises(AssertionError):
        chat.masked_tokens(np.array([4, 8]), np.array([[2, 8]]))


def test_nothing_else_imports_the_subpackage():
    import ast
    from pathlib import Path

    top = Path(html.__file__).resolve().parents[1]
    for file in top.rglob("*.py"):
        if file.parent.name != "llm":
            for node in ast.walk(ast.parse(file.read_text())):
                names = [a.name for a in node.names] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
                names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in name.split(".") for name in names), file


def test_words_of_arrow_slices():
    from rowsmith.llm.text import Words

    texts = pa.array(["skip", None, " a\tbB ", "", "é x"]).slice(1)
    words = Words(texts, lower=True)
    assert [words.word(i) for i in range(len(words))] == ["a", "bb", "é", "x"]
    assert words.row.tolist() == [1, 1, 3, 3] and words.per_row().tolist() == [0, 2, 0, 2]


def test_language_model_reads_texts_twice_and_trains_on_classes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a{i} b c. " * (i % 30)) for i in range(60)] + [(60, None), (None, "x y")], "doc_id bigint, text string")
    seen = []
    train = lm.Model.train
    monkeypatch.setattr(lm.Model, "train", lambda self, rows: seen.append(rows.collect()) or train(self, rows))
    found = {r.doc_id: r for r in lm.score(docs, BPE).collect()}
    [rows] = seen
    learnt = [r for i, r in found.items() if i is not None and not r.held_out]
    assert sorted(len(r.classes) for r in rows) == sorted(r.n_tokens for r in learnt)
    assert all(r.classes[-1] == lm.END_CLASS and lm.END_CLASS not in r.classes[:-1] for r in rows)


def test_language_model_gradient_of_wanted_places_only():
    rng = np.random.default_rng(4)
    w = lm.start_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    inputs, valid, place = lm.frames(rng.integers(0, lm.END_CLASS, 31), np.array([0, 25, 30, 31]), 0, 25)
    z = lm.forward(w, inputs, valid, place >= 0)[0]
    assert z.shape == (31, lm.CLASSES)
    loss, g = lm.gradient(w, inputs, valid, np.maximum(place, 0) % lm.END_CLASS, np.zeros(place.shape, bool))
    assert loss == 0 and set(g) == set(w) and not any(x.any() for x in g.values())


def test_language_model_logs_do_not_depend_on_the_texts_beside():
    rng = np.random.default_rng(1)
    w = lm.start_weights(np.full(lm.CLASSES, 1 / lm.CLASSES))
    begin = np.r_[0, np.cumsum(rng.integers(1, 90, 92))]
    classes = rng.integers(0, lm.CLASSES, begin[-1])
    parts = [(a, min(a + 13, 92)) for a in range(0, 92, 13)]
    alone = [lm.class_logs(w, classes[begin[a] : begin[b]], begin[a : b + 1] - begin[a]) for a, b in parts]
    assert (np.concatenate(alone) == lm.class_logs(w, classes, begin)).all()
