"""Training-data operators (ten), each a module of its own; nothing else in the library imports this package."""
