"""DataFrame-to-DataFrame operators: capture, filters, conversion, routing, order, replay."""
