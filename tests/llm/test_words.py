"""The class of word characters."""

import re

from starmart.llm.common import CASED_WORD


def test_word_characters_are_looked_up_and_the_same():
    assert "-" not in CASED_WORD  # no ranges, which Java's regex tries in turn
    ranges = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x11000), 0x1F600]))
    assert re.findall(CASED_WORD, text) == ranges.findall(text)
