"""The word table and the vocabularies of its labels."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a word file in order, those that hold whole numbers, and the types of the label columns.
WORD_COLUMNS = ("sequence", "segment", "text", "page", "page_width", "page_height", "fontname", "rgb", "x0", "x1", "top", "bottom", "doctop", "mcid", "mctag", "tagstack")
WORD_INTS = ("page", "page_width", "page_height", "x0", "x1", "top", "bottom", "doctop", "mcid")
BLOCK_TYPES = ("Titre", "Alinea", "Liste", "Tete", "Pied", "TOC", "Tableau", "Figure", "Article", "Section", "SousSection", "Chapitre", "Annexe", "Amendement")
SPAN_TYPES = ("Titre", "Numero", "Amendement")
# The levels of the outline, the highest first.
LEVELS = ("Document", "Annexe", "Chapitre", "Section", "SousSection", "Article")

WORD_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c in WORD_INTS else T.StringType()) for c in WORD_COLUMNS])
