"""End-to-end flows, and the size checks that operators share."""
