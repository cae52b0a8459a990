"""Rows that every operator on documents must handle."""

EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (5, "one two"),
    (5, "one two"),
    (6, "One TWO"),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z zz"),
    (9, "word " * 60_000),
    (10, "é" * 5000 + " 日本語 😀 <|endoftext|> 's"),
    (None, "one two"),
    (None, "no id here at all"),
]
