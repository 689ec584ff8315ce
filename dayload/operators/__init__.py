"""Row filters, the normalising projection, and the keyed comparison."""
