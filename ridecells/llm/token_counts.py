"""Token counts that follow edits, from a segment tree over each document.

A document is cut after blanks into leaves of some words; a vocabulary that
never merges across blanks counts each leaf alone. Sums of code points and of
tokens over the leaves form a binary tree in two arrays (root at 1, children of
i at 2i and 2i+1). An edit finds its leaves by the sums of code points, encodes
the text of these leaves anew, and of those after them as long as the edited
stretch doesn't end in a blank, and updates the sums above them. The rest of the
document is neither read nor encoded.

Null and empty texts have a tree of one empty leaf. Edits are applied in order,
each to the text that the one before left; places beyond the text are moved to
its end, a null list counts as none, a null replacement as empty, a null start as
the text's start and a null end as the edit's start. Rows are
independent, so repeated rows and ids are no matter. No documents give no rows.
"""

import numpy as np
from pyspark.sql import functions as F

from ridecells.llm.common import arrow_batch, arrow_schema
from ridecells.llm.tokens import encoder

LEAF_WORDS = 16


class CountTree:
    """Code points and tokens of a text's leaves, and their sums."""

    def __init__(self, chars, tokens):
        self.width = 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        for sums, leaves in ((self.chars, chars), (self.tokens, tokens)):
            sums[self.width:self.width + len(leaves)] = leaves
            at = self.width
            while at > 1:
                sums[at // 2:at] = sums[at:2 * at].reshape(-1, 2).sum(axis=1)
                at //= 2

    @classmethod
    def of(cls, text, encode):
        return cls(*_leaves(text, encode))

    @classmethod
    def from_sums(cls, chars, tokens):
        """The tree whose arrays were stored."""
        tree = cls.__new__(cls)
        tree.chars, tree.tokens = np.array(chars, np.int64), np.array(tokens, np.int64)
        tree.width = len(chars) // 2
        return tree

    def leaf(self, place):
        """(leaf, its first code point) that holds the place; of the end, the last leaf with text."""
        place, at, start = min(place, int(self.chars[1]) - 1), 1, 0
        while at < self.width:
            at *= 2
            if place - start >= self.chars[at]:
                start += int(self.chars[at])
                at += 1
        return at - self.width, start

    def edit(self, text, start, end, replacement, encode):
        """The edited text; the tree follows. Returns it with the code points encoded anew."""
        size = len(text)
        start = min(max(0, start), size)
        end = min(max(start, end), size)
        after = text[:start] + replacement + text[end:]
        if not size:
            self.__init__(*_leaves(after, encode))
            return after, len(after)
        first, region_start = self.leaf(start)
        last, at = self.leaf(max(start, end - 1))
        region_end = at + int(self.chars[self.width + last])
        grown = len(replacement) - (end - start)
        while region_end < size and after[region_start:region_end + grown][-1:] not in ("", " "):
            last, at = self.leaf(region_end)
            region_end = at + int(self.chars[self.width + last])
        region = after[region_start:region_end + grown]
        chars, tokens = _leaves(region, encode)
        room = last - first + 1
        if len(chars) > room:
            own, width = slice(self.width, self.width + first), self.width
            rest = slice(width + last + 1, 2 * width)
            self.__init__(np.concatenate([self.chars[own], chars, self.chars[rest]]), np.concatenate([self.tokens[own], tokens, self.tokens[rest]]))
            return after, len(region)
        for sums, leaves in ((self.chars, chars), (self.tokens, tokens)):
            sums[self.width + first:self.width + last + 1] = 0
            sums[self.width + first:self.width + first + len(leaves)] = leaves
            low, high = (self.width + first) // 2, (self.width + last) // 2
            while low:
                sums[low:high + 1] = sums[2 * low:2 * high + 2].reshape(-1, 2).sum(axis=1)
                low, high = low // 2, high // 2
        return after, len(region)


def _leaves(text, encode):
    """Code points and tokens of the text's leaves; each but the last ends in a blank."""
    words = text.split(" ")
    parts = [" ".join(words[i:i + LEAF_WORDS]) + " " for i in range(0, len(words), LEAF_WORDS)]
    parts[-1] = parts[-1][:-1]
    if len(parts) > 1 and not parts[-1]:
        parts.pop()
    return np.array([len(p) for p in parts]), np.array([len(encode(p)) // 4 for p in parts])


def _encode(tokenizer):
    own = encoder(tokenizer)
    if not own.by_pieces:
        raise ValueError("this vocabulary may merge across blanks")
    return own.ids


def count_trees(docs, tokenizer):
    """doc_id, text, tree_chars, tree_tokens and n_tokens of every document."""
    layout = "doc_id bigint, text string, tree_chars array<bigint>, tree_tokens array<bigint>, n_tokens bigint"

    def build(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tree = CountTree.of(text or "", _encode(tokenizer))
                out.append((doc_id, text, tree.chars, tree.tokens, int(tree.tokens[1])))
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    return docs.select("doc_id", "text").mapInArrow(build, layout)


def edited(docs, edits, tokenizer, with_trees=False):
    """Counts before and after the edits of every document.

    ``edits`` is a column: an array of structs (start, end, replacement) in code
    points, end exclusive. Trees in tree_chars and tree_tokens, from
    ``count_trees``, are used where the frame has them, else built. Returns
    doc_id, n_tokens, n_edited_tokens, n_edited_chars and n_encoded (code points
    encoded for the edits); with trees also text, tree_chars and tree_tokens.
    """
    layout = "doc_id bigint, n_tokens bigint, n_edited_tokens bigint, n_edited_chars bigint, n_encoded bigint" + (
        ", text string, tree_chars array<bigint>, tree_tokens array<bigint>" if with_trees else "")
    kept = [c for c in ("tree_chars", "tree_tokens") if c in docs.columns]
    if len(kept) == 1:
        raise ValueError("a tree has both tree_chars and tree_tokens")

    def apply(batches):
        encode = _encode(tokenizer)
        for batch in batches:
            out = []
            for doc_id, text, changes, *sums in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                tree = CountTree.from_sums(*sums) if sums else CountTree.of(text, encode)
                before, encoded = int(tree.tokens[1]), 0
                for change in changes or []:
                    start = change["start"] or 0
                    end = start if change["end"] is None else change["end"]
                    text, n = tree.edit(text, start, end, change["replacement"] or "", encode)
                    encoded += n
                row = (doc_id, before, int(tree.tokens[1]), len(text), encoded)
                out.append((*row, text, tree.chars, tree.tokens) if with_trees else row)
            yield arrow_batch(out, schema)

    schema = arrow_schema(layout)
    return docs.select("doc_id", "text", edits.alias("edits"), *kept).mapInArrow(apply, layout)


def change(start, end, replacement):
    """One edit as a column."""
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), replacement.alias("replacement"))
