"""Training-data operators; ``tradewind.llm.queries`` registers them."""
