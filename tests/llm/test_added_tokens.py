import numpy as np
from tokenizers import Tokenizer

from riskspark.llm import tokens
from riskspark.llm.queries import tokenizer_path


def test_added_tokens_have_their_id():
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["<|endoftext|>", "a <|endoftext|> b", "One text.<|endoftext|>Another\n one", "<|endoftext|", "no such mark here, at all\nnone", " <|endoftext|>\n\n<|endoftext|>x"]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.Encoder(tokenizer_path()).encode(texts)] == want
    assert len(want[0]) == 1
