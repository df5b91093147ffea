"""Table-in, table-out operators: parsing, entities, edges, upserts, histories, quality."""
