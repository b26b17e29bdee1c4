"""DataFrame-to-DataFrame operators; each is a declarative plan over built-in expressions."""
