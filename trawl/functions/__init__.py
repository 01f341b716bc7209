"""Column-level functions: html extraction, URL canonical form, tokenizer."""
