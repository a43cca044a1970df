"""White space of another kind at the edge of a piece."""

from recordlens.llm.encode import encoder
from recordlens.llm.queries import tokenizer_path


def test_white_space_at_the_edge_of_a_piece():
    enc = encoder(tokenizer_path("byte_bpe_50k.json"), True)
    texts = ["1\n\xa0\t1", "a \tb", "a\t b", "a\n\x1fb", "\ta", "a\xa0", "a b\nc", "\t", " ", "a\n\nb"]
    assert [x.tolist() for x in enc.encode(texts)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
