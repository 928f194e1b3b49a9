"""Training-data operators. Nothing outside this subpackage imports it, except the entry module's guard."""
