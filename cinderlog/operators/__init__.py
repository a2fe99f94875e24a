"""DataFrame operators. Each takes DataFrames and returns DataFrames; nothing runs until they are used."""
