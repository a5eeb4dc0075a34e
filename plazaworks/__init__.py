"""plazaworks: marketplace operations analytics on Spark DataFrames."""
