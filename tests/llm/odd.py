"""Texts that every operator must take: null, empty, blanks, ties, repeats."""

ODD = [None, "", "   \n\t ", "a", "a", "one two", "one two three four five",
       "\U0001f600 é ñ ß   x", "a@b.c 1.2.3.4 +1 (555) 123-4567", "x" * 5000,
       "word " * 3000, "\n".join(["same line of words"] * 60), "<|endoftext|> tail",
       "l'été 'll 'S 123abc __ ... \r\n\r\n  end  "]
