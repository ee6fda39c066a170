"""The layers built from the operators: silver tables, star schema, quality views, analyses, loads."""
