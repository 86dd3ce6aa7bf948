"""DataFrame operators: validate, gate, extract, dedupe, enrich, embed, search, route, measure."""
