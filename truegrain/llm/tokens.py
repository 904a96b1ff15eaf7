"""Token ids of whole texts by a public tokenizer, word by word with a bounded cache in each worker."""

from __future__ import annotations

from array import array

#: Words kept by a worker; beyond it the cache starts anew, beside the one before it. Longer words are not kept.
CACHE_WORDS, CACHE_LENGTH = 150_000, 40


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Word -> bytes of its ids (little-endian unsigned 32 bit), for a tokenizer that drops white space.

    Such a tokenizer never looks across white space, so the ids of a text are those of its words in
    turn, and the ids of a word those of its runs of letters, single digits and runs of other signs.
    For Latin-1 words without apostrophes these pieces go straight to the model: there the tokenizer's
    clean-up does nothing but lower each letter. All else is encoded by the tokenizer as it stands.
    """

    def __init__(self, path: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.older = {}
        self.encoder = Tokenizer.from_file(path)
        self.model = self.encoder.model.tokenize
        self.split = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.special = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        # the byte-level alphabet: printable bytes stand for themselves, the others for what follows U+00FF
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in kept]
        self.letters = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}

    def piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model(spelled)]).tobytes()

    def encode(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.model(word)]).tobytes() if word.islower() else self[word.lower()]
        low = word.lower()
        if not latin(word) or "'" in word or any(s in low for s in self.special) or not word.isprintable():
            return array("I", self.encoder.encode(word, add_special_tokens=False).ids).tobytes()
        parts = self.split(low)
        return self.piece(low) if parts == [word] else b"".join(map(self.__getitem__, parts))

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
                dict.__setitem__(self, "", b"")
            dict.__setitem__(self, word, ids)
        return ids

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if latin(text) and not any(s in (low := text.lower()) for s in self.special):
            text = low
        for space in "\t\n\x0b\x0c\r":
            if space in text:
                text = text.replace(space, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


def byte_pairs(path: str):
    """A byte-level tokenizer from a file of ranks; it keeps every byte, and no text is special to it."""
    import base64

    import public_tokenizers
    import tiktoken

    caches = vars(tiktoken).setdefault("_byte_pairs", {})
    if path not in caches:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        caches[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return caches[path]


def latin(text: str) -> bool:
    """Whether all characters are Latin-1; such text is in normal form C, and lower-casing goes letter by letter."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def word_ids(path: str) -> WordIds:
    """The cache of this process. Functions are sent by value and their globals last for one task, so
    it hangs on the tokenizer library, which stays loaded as long as the worker does."""
    import tokenizers

    caches = vars(tokenizers).setdefault("_word_ids", {})
    if path not in caches:
        caches[path] = WordIds(path)
    return caches[path]
