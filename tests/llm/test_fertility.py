import math
from collections import Counter

import public_tokenizers
import sentencepiece

from docketry.llm import fertility as f
from tests.llm import cases

PATH = public_tokenizers.path(f.VOCABULARY)


def plain(model, text):
    text = text or ""
    words = cases.WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if cases.WORD.search(x)]
    tokens = [i for w in words for i in model.encode(w)]
    counts = Counter(tokens)
    n = len(tokens)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        failed, n, round(sum(map(len, words)) / n, 9) if n else 0.0, round(sum(map(model.is_byte, tokens)) / n, 9) if n else 0.0,
        round(entropy, 9) + 0.0,
    )


def test_against_a_plain_version(spark, docs, doc_rows, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = f.judge(docs, PATH).collect()
    found = [
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
         r["n_tokens"], round(r["chars_per_token"], 9), round(r["byte_share"], 9), round(r["token_entropy"], 9) + 0.0)
        for r in rows
    ]
    assert sorted(found, key=str) == sorted(((r[0], *plain(model, r[1])) for r in doc_rows), key=str)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    clean = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 120 and r["doc_id"] % 10 and not r["base_failed"]]
    assert clean and all(r["kept"] for r in clean)
    assert f.judge(no_docs, PATH).count() == 0


def test_bands_reject():
    pieces = f.PieceCounter(PATH)

    def judged(text):
        words = f.WORD.findall(text)
        pieces.learn(words)
        return f.measure(text, words, pieces, f.BANDS)

    prose = "the quick brown fox jumps over a lazy dog while seven other animals watch it from behind the old wooden fence near our house"
    assert judged(prose)[-1]
    assert not judged(" ".join(f"{i}x{i}" for i in range(40)))[-1]
    assert not judged(prose + " " + " ".join(f"la{'la' * (i % 2)} la" + "\n" * (i % 3) for i in range(400)))[-1]
    assert not judged(" ".join(f"é\U0002070e\U0002071b{i}" for i in range(30)))[-1]


def test_repeats_and_lines():
    assert f.duplicate_lines("a\na\n\n \n\nb\na ") == 1
    import numpy as np

    words = np.array([0, 1, 2, 3, 4, 5, 6, 7, 0, 1, 2, 3, 4, 5, 6, 7, 8])
    assert f.repeated_words(words) == 16
    assert f.repeated_words(np.zeros(30, int)) == 30
    assert f.repeated_words(np.arange(30)) == 0
    assert f.repeated_words(np.zeros(8, int)) == 0
    assert f.repeated_words(np.zeros(9, int)) == 9


def test_scripts():
    wanted = {"": "other", "123": "other", "abc": "latin", "été": "latin", "привет abc": "cyrillic", "漢字": "han", "かな漢": "kana", "한국어": "hangul", "γεια": "greek"}
    assert {t: f.script_of(t) for t in wanted} == wanted
