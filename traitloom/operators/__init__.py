"""Table operators: DataFrame in, DataFrame out, nothing runs until the caller asks for rows."""
