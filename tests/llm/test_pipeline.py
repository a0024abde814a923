"""The pipeline as a whole, on documents of which each stage has something to do; and the columns of the registered queries."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tallygrid.llm.queries import registry

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TINY = "/root/testdata/sf0.001"


def documents(rng):
    vocabulary = ["stone", "river", "cloud", "garden", "window", "letter", "morning", "paper", "forest", "silver", "table", "yellow"]
    line = lambda n: " ".join(rng.choice(vocabulary, n)) + f" {rng.integers(10**6)}"
    texts = [f"{line(30)}\n{line(25)}" for _ in range(120)]
    boiler = line(20)
    texts[5] += f"\n{boiler}"
    texts[9] += f"\n  {boiler}"
    texts[11] += f"\n{boiler[:-1]}x"
    texts[20] += "\npay with 4111 1111 1111 1111 or write to ann.lee@mail.example.com"
    texts.append("too short")  # 120
    texts.append(" ".join(["same words again and again here today now"] * 30))  # 121
    texts.append(texts[40].replace("\n", " "))  # 122, the words of 40 in one line
    texts.append(" ".join(rng.choice(vocabulary, 6000)))  # 123, far longer than all others
    return texts


def test_chain(spark, tmp_path):
    texts = documents(np.random.default_rng(30))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(124, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(WORD_BPE)
    made = {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        made.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    # Bad documents and the near copy went, all clean ones stayed.
    assert set(made) == set(range(120))
    expected = dict(enumerate(texts))
    boiler = expected[5].split("\n")[2]
    for i in (9, 11):
        expected[i] = "\n".join(expected[i].split("\n")[:2])
    for i, ids in made.items():
        if i != 20:
            assert ids == library.encode(expected[i], add_special_tokens=False).ids + [0], i
    assert boiler in expected[5]
    shown = library.decode(made[20][:-1])
    assert "4111" not in shown.replace(" ", "")[shown.replace(" ", "").find("paywith") :][:30] or "4111111111111111" not in shown.replace(" ", "")
    assert "ann" not in re.sub(r"[^a-z ]", " ", shown).split()
    assert max(r.offset + r.length for r in pieces) <= 2048
    total = sum(len(ids) for ids in made.values())
    assert len({r.sequence_id for r in pieces}) <= -(-total // 2048) + 2


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "pseudonyms", "packed"]
    assert corpus_pipeline.ORACLE_SQL is None


COLUMNS = {
    "op2_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op3_chunk_reuse_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op6_huffman_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_robust_outliers": {
        "doc_id": "bigint",
        **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "bigint"),
        **dict.fromkeys(("base_failed", "kept"), "boolean"),
    },
}


def test_columns_and_digests_of_registered_queries(spark):
    """Names, types, unsigned checksums and hexadecimal forms."""
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    for name, columns in COLUMNS.items():
        found = registry()[name][0](spark, TINY)
        kinds = dict(found.dtypes)
        assert {c: kinds[c] for c in columns} == columns
        assert {r.doc_id for r in found.select("doc_id").collect()} == set(rows)
    packed = registry()["op2_best_fit_packing"][0](spark, TINY).where("doc_id < 5").collect()
    library = Tokenizer.from_file(WORD_BPE)
    for r in packed:
        ids = library.encode(rows[r.doc_id], add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    marked = registry()["op7_simhash"][0](spark, TINY).collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in marked)
    assert all(r.component_id <= r.doc_id for r in marked)
