"""Ids of texts that hold added tokens must be those of the tokenizer file's
own library as it is loaded."""

import json

import pytest
from tokenizers import Tokenizer

from shopstream.llm import packing, queries

from .test_simhash_packing_pipeline import check_packing

SPECIAL = ["end of sample <|endoftext|> next", "<|endoftext|>", "a  \n <|endoftext|><|endoftext|>\n\n b", "x<|endoftext|",
           "<|endoftext|>'s   ", "é<|endoftext|>漢字"]


def own_file(tmp_path, **changes):
    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0].update(changes)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("changes", [{}, {"lstrip": True}, {"single_word": True}, {"special": False}])
def test_added_tokens_get_their_ids(tmp_path, changes):
    path = own_file(tmp_path, **changes)
    own, enc = Tokenizer.from_file(path), packing._encoder(path)
    assert bool(enc.fast) == (not {"lstrip", "single_word"} & set(changes))
    for t in SPECIAL:
        assert enc.encode(t).tolist() == own.encode(t, add_special_tokens=False).ids


def test_packing_of_added_tokens(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(SPECIAL)]
    got = packing.pieces(docs_of(rows), queries.tokenizer_path(), window=16).collect()
    check_packing(rows, got, Tokenizer.from_file(queries.tokenizer_path()), 16)
    assert {r.doc_id: r.doc_tokens for r in got}[0] == 7
