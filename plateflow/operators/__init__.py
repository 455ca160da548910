"""Analytics over a marketplace. Each function is ``f(market, as_of, **parameters) -> DataFrame``."""
