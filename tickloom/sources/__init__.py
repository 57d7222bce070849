"""Tables of bars: parsers of exchange files, and bars derived from order lines and events."""
