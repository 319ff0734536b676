import pytest

pytest.importorskip("tiktoken")

from tokenizers import Tokenizer  # noqa: E402

from kindred.llm import tokens  # noqa: E402


def test_literals_of_added_tokens():
    """Held against the vocabulary's own tokenizer, read anew."""
    encode, own = tokens.load(tokens.folder(), "byte_bpe_50k"), Tokenizer.from_file(f"{tokens.folder()}/byte_bpe_50k.json")
    for t in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>  x", "日本 <|endoftext|>", "a <|endoftext| b", "plain"):
        ids = encode(t)
        assert ids.tolist() == own.encode(t, add_special_tokens=False).ids
        assert encode.bytes_of[ids].sum() == len(t.encode())
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
