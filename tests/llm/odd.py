"""Texts that are easy to get wrong."""

#: Null, empty, blank, one word, ties, repeated rows, odd characters.
ODD = [None, "", " \n\t ", "a", "a", "Straße 🙂  naïve x\x1c\n\n  y", "the the the the the the the"]
