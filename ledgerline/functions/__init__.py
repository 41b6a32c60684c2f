"""ledgerline.functions."""
