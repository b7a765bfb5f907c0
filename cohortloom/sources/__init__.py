"""Files as DataFrames: family records, tables of any delimiter, archives, gene annotation."""
