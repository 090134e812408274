"""Token ids of whole texts, by a public tokenizer's files."""

import base64
import os
from array import array

END_ID = 0  # fixed value: the contracts' end of a document
COMPARED = 10  # texts of each task that both libraries encode


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of a byte-level BPE, as its tokenizers file gives them.

    The ranks of the same vocabulary, beside that file with the ending .tiktoken, give the
    same ids in a fifth of the time and do the bulk. The first texts of every task are
    encoded by both libraries; a difference is an error. Texts that the ranks' library
    gives up on are encoded by the file alone. The file's added tokens have their own ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.compared = 0

    def ids(self, text: str | None) -> bytes:
        """Unsigned 32-bit ids, little-endian as the machines Spark runs on; no end id."""
        if not text:
            return b""
        ids = self._by_ranks(text)
        if ids is None or self.compared < COMPARED:
            want = self.tokenizer.encode(text, add_special_tokens=False).ids
            if ids is not None:
                self.compared += 1
                if ids != want:
                    raise ValueError("the tokenizer's two files disagree")
            ids = want
        return array("I", ids).tobytes()

    def _by_ranks(self, text: str) -> list[int] | None:
        """None for a text, as one with a very long run of blanks, that is too deep for the pattern."""
        try:
            return self.ranks.encode(text, allowed_special="all")
        except BaseException as error:  # the library's own error, or a panic, which is no Exception
            if not isinstance(error, ValueError) and type(error).__name__ != "PanicException":
                raise
            return None
