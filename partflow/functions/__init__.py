from partflow.functions.scalars import (  # noqa: F401
    add_rounded, emptiness, json_number, key_bytes, kind_label, money,
    split_words, word_count_text,
)
