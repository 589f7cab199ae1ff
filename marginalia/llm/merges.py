"""Ids of single words by a tokenizer's merges alone, each word once."""

from __future__ import annotations

from array import array

from marginalia.llm.byte_bpe import byte_characters

#: Characters without white space that Unicode normalisation leaves alone, and which of them are letters and digits.
PLAIN = "!-~¡-¬®-ſ"
LOWER_LETTERS, LETTERS, DIGITS = "a-zªµºß-öø-ſ", "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"


class Words(dict):
    """Ids, as bytes, of words of plain text by a byte-level tokenizer of the ``tokenizers`` library."""

    def __init__(self, tokenizer, code: str):
        self.merge, self.code, self.latin = tokenizer.model.tokenize, code, dict(enumerate(byte_characters()))

    def __missing__(self, word: str) -> bytes:
        written = word.encode().decode("latin-1").translate(self.latin)
        ids = self[word] = array(self.code, [token.id for token in self.merge(written)]).tobytes()
        return ids
