"""Operations for preparing text and vectors as training data, on Spark DataFrames."""
