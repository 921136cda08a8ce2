"""Tables: declared schemas, the shop model, file layouts."""
