"""What a published piece vocabulary says about which pieces may stand side by side.

Merging always takes the best-scored pair of neighbours. The pieces of a prefix are therefore the
prefix's own pieces: a sequence of pieces is the segmentation of its text exactly when every two
neighbours are the segmentation of theirs. So the last piece of each prefix is determined by the
last pieces of shorter prefixes, which both the counting transducer and the lattice search rest on.
"""

from __future__ import annotations

from functools import lru_cache

SPACE = "▁"


class Pieces:
    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        self.ids = {names[i]: i for i in range(n) if not special[i]}
        self.scores = {names[i]: model.get_score(i) for i in range(n) if not special[i]}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        self.heads = {name[:k] for name in self.ids for k in range(1, len(name))}
        self.pairs = {name[k : k + 2] for name in self.ids for k in range(len(name) - 1)}
        #: Bytes that each id stands for when decoded.
        self.bytes = [b"" if special[i] else names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        #: A piece never goes on over the start of a word, nor over a line break.
        self.words_apart = not any(SPACE in name.lstrip(SPACE) for name in self.ids) and not any("\n" in name for name in self.ids)
        self.together = lru_cache(maxsize=200_000)(self._together)

    def merge(self, text: str) -> list[str]:
        """The segmentation of a short text by repeated best merges."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _together(self, left: str, right: str) -> bool:
        """Whether two pieces may be neighbours; an empty left piece is a border."""
        if left and left[-1] + right[0] not in self.pairs:
            return right in self.ids and self.merge(right) == [right]
        return self.merge(left + right) == ([left, right] if left else [right])

    def cuts(self, text: str) -> list[str]:
        """The text cut wherever no piece holds the two neighbouring characters."""
        pairs, out, start = self.pairs, [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in pairs:
                out.append(text[start:i])
                start = i
        out.append(text[start:])
        return out


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    return Pieces(path)


def segments(text: str) -> list[str]:
    """Parts of a text that are segmented on their own, as keys.

    A key without a leading line break stands for a space mark and the key; a key that starts with one
    stands for the break and the rest. The text is taken to start with a space mark.
    """
    if not text:
        return []
    words = text.replace(SPACE, " ").replace("\n", " \n").split(" ")
    if "" not in words:
        return words
    # runs of spaces stay with what follows them; a run before a line break or the end stands alone
    out, run = [], 0
    for i, word in enumerate(words):
        if word.startswith("\n"):
            if run:
                out.append(SPACE * (run - 1))
            run = 0
            out.append(word)
        elif word == "" and i + 1 < len(words):
            run += 1
        else:
            out.append(SPACE * run + word)
            run = 0
    return out


def spelled(key: str) -> tuple[str, str]:
    """The line break in front of a key, if any, and the characters to segment."""
    return ("\n", key[1:]) if key.startswith("\n") else ("", SPACE + key)
