"""The same steps over streams. Stateless steps need nothing of their own: the
operators in ``operators.recover`` and ``operators.lines`` take streaming DataFrames."""
