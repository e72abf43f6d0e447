"""The corpus pipeline against plain versions of its stages."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

import corpus_pipeline  # noqa: E402
import test_operators as plain  # noqa: E402
from rillmart.llm import language, queries, shared  # noqa: E402
from test_operators import awkward, empty  # noqa: E402, F401


def test_stages(spark):
    if not os.path.isdir(plain.SF_DIR):
        pytest.skip("no test tables here")
    from tokenizers import Tokenizer

    docs, made = shared.documents(spark, plain.SF_DIR), []
    for name, stage in corpus_pipeline.STAGES:
        out = shared.settled(stage(spark, docs, plain.SF_DIR), name)
        made.append(out)
        assert name == "encode" or out.columns == docs.columns
        docs = out
    known, lined, near, mixed, encoded = made
    whole = shared.documents(spark, plain.SF_DIR)
    dictionaries = language.learn(whole.filter(~language.held_out(whole["doc_id"])))
    clear = [row for row in plain.pairs(whole) if plain.clear_language(row[1], dictionaries)]
    assert plain.pairs(known) == clear
    texts = plain.plain_long_lines(plain.pairs(known), 50)
    wanted = [(k, texts[k, t]) for k, t in plain.pairs(known) if texts[k, t].strip(" ")]
    assert plain.pairs(lined) == sorted(wanted, key=repr)
    kept = plain.similar_kept(plain.pairs(lined))
    assert plain.pairs(near) == [row for row in plain.pairs(lined) if row[0] in kept]
    assert set(plain.pairs(mixed)) <= set(plain.pairs(near))
    sizes, taken, most = {}, {}, {}
    for k, t, s in plain.pairs(near, "doc_id", "text", "source"):
        sizes[s] = sizes.get(s, 0) + len(plain.words_of(t))
        most[s] = max(most.get(s, 0), len(plain.words_of(t)))
    for k, t, s in plain.pairs(mixed, "doc_id", "text", "source"):
        taken[s] = taken.get(s, 0) + len(plain.words_of(t))
    for s, target in plain.shares(sizes).items():
        assert abs(taken.get(s, 0) - target) <= most[s] / 2 + 1e-6
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    ids = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in plain.pairs(mixed)]
    assert plain.pairs(encoded, "doc_id", "token_ids") == sorted(ids, key=repr)


@pytest.mark.parametrize("table", ["awkward", "empty"])
def test_stages_on_awkward_rows(request, spark, table):
    """Nulls, ties, repeated ids and rows, long texts and columns of clashing names pass all stages."""
    docs = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        out = shared.settled(stage(spark, docs, plain.SF_DIR), name)
        assert name == "encode" or out.columns == docs.columns
        assert name == "mix_sources" or out.count() <= docs.count()
        docs = out
    assert (docs.count() == 0) == (table == "empty")
