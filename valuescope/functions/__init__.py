"""Column -> Column functions (text, scalars, vectors)."""

from .scalars import shorten_term, shorten_term_col, slug, slug_text, to_int  # noqa: F401
from .text import STOP_WORDS_EN, note, treebank_tokens, word_tokens  # noqa: F401
from .vectors import fingerprint64, fold8, median_bits, vector_median  # noqa: F401
